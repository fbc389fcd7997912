"""Small generated tables with copies, near copies, shared passages, hot sources and odd rows."""

import random

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
          "size string, key string, rate string, found string, words string, component string, removed string")
VOCABULARY = {
    "en": "the of and to in that was for on with house river stone light answer winter garden".split(),
    "de": "der die und das nicht mit für über haus fluss stein licht antwort größe garten".split(),
    "fr": "le la les et des une pour dans maison rivière pierre lumière réponse hiver été".split(),
    "es": "el los las y en una por con casa río piedra luz respuesta invierno jardín".split(),
}


def sentence(rng, lang, n):
    return " ".join(rng.choice(VOCABULARY[lang]) + rng.choice(["", "a", "en", "o", "st"]) for _ in range(n))


def texts(seed, n):
    rng = random.Random(seed)
    passage = sentence(rng, "en", 30)
    made = []
    for k in range(n):
        lang = rng.choice(list(VOCABULARY))
        roll = rng.random()
        if made and roll < 0.15:
            text, lang = rng.choice(made)
        elif made and roll < 0.35:
            text, lang = rng.choice(made)
            w = text.split(" ")
            w[rng.randrange(len(w))] = f"x{k}"
            text = " ".join(w)
        else:
            text = "\n".join(sentence(rng, lang, rng.randint(1, 40)) for _ in range(rng.randint(1, 5)))
            if roll > 0.8:
                text += "\n" + passage
        made.append((text, lang))
    return made


def rows(seed, n=60):
    """Ordinary rows, a third of them from one source."""
    rng = random.Random(seed)
    return [(k, t, lang, "hot" if rng.random() < 0.33 else f"s{rng.randrange(4)}", len(t), *["1"] * 7)
            for k, (t, lang) in enumerate(texts(seed, n))]


def odd_rows(seed=1):
    """Nulls in every column, empty and very long texts, ties, repeated rows."""
    rng = random.Random(seed + 1000)
    long = sentence(rng, "en", 4000)
    base = rows(seed, 12)
    return [*base, base[3], base[3], (None, "a text without an id, in the house", "en", "s1", None, *[None] * 7),
            (100, None, "en", "s1", 1, *["2"] * 7), (101, "", None, None, None, *["2"] * 7),
            (102, " \t\n ", "de", None, 0, *["2"] * 7), (103, "1234 --- 5678", "en", "hot", 3, *["2"] * 7),
            (104, long, "en", None, 1, *["2"] * 7), (105, long, "en", "hot", 1, *["2"] * 7),
            (106, "ééé   日本語", "fr", "s2", 2, *["2"] * 7)]


def frame(spark, data):
    return spark.createDataFrame(data, SCHEMA)
