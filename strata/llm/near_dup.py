"""MinHash near-duplicates by a signature-coordinate inverted join.

1. *Sets.* A text's set holds its distinct ``shingle``-word shingles (64-bit hashes). Equal sets are
   one class, represented by its least doc_id; classes, not copies, go on.
2. *Postings.* A signature has ``COORDINATES`` minima. A class is posted under its pairs of coordinate
   and value. Two sets as similar as ``threshold`` agree in ``MATCHES`` coordinates or more but for
   about three pairs in 100,000 at the threshold itself (``MATCHES`` lies four standard deviations under the mean).
   Values of one class only are dropped, classes with fewer than ``MATCHES`` shared
   values are skipped, and of the rest each posts only its rarest ``shared - MATCHES + 1``
   values: two classes with ``MATCHES`` in common meet in one of them (prefix filter).
3. *Links.* Only components are wanted, so a posting list need not be multiplied out. First
   each member is compared, on full sets, with one hub of its list, the member whose values are
   the most shared: of a text and its near copies that is the text. Lists whose members are
   all connected by then are done, and lists of the same members are kept once. In the rest, tasks
   count collisions of full sets on an inverted index of the list (``_settle``): each member outside
   the list's largest component against all others at once, which is exact and emits links only. A list over
   ``BLOCK`` members is dealt as pairs of blocks, so no task holds more. No cap on lists, partners or candidates.
4. Components by star contraction (``components.py``).

Defined results: null, or a text without words, has an empty set and is linked with nothing; each row is a
node of its own, also where rows share a doc_id or have none; rows without doc_id come last. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm import textbatch as tb
from strata.llm.components import components
from strata.llm.shared import distinct_ids, identified, partitions, stored

COORDINATES, MATCHES, SALT, BLOCK, SALTS = 64, 38, 256, 4096, 32
U = np.uint64
_rng = np.random.Generator(np.random.PCG64(17))
_MULTIPLY = _rng.integers(0, 2**63, COORDINATES, dtype=U) * U(2) + U(1)
_ADD = _rng.integers(0, 2**63, COORDINATES, dtype=U)


def shingle_sets(texts: pa.Array, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingles of every row, one after the other, and the offsets of the rows."""
    data, offsets = tb.buffers(texts)
    start, end, first = tb.words(data, offsets)
    sums = tb.prefix_sums(tb.word_hashes(data, start, end, lower=True))
    windows = tb.window_hash(sums, shingle)
    out, at = [], [0]
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= shingle:
            own = np.sort(windows[a: b - shingle + 1])
            own = own[np.r_[True, own[1:] != own[:-1]]]
        elif b > a:
            own = tb.span_hash(sums, np.array([a]), np.array([b]))
        else:
            own = windows[:0]
        out.append(own)
        at.append(at[-1] + len(own))
    return (np.concatenate(out) if out else np.zeros(0, U)), np.array(at)


def _identity(h: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit sums that stand for a set (rows must not be empty)."""
    return (np.add.reduceat(tb.mix(h ^ U(0x5555)), at).astype(np.int64),
            np.add.reduceat(tb.mix(h + U(0x1234567)), at).astype(np.int64))


SIGNED = "doc_id long, n_shingles long, id1 long, id2 long, keys array<long>"


def _sign(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tb.chunks(batches):
            h, at = shingle_sets(batch.column("text"), shingle)
            size = np.diff(at)
            live = np.flatnonzero(size)
            id1, id2 = np.zeros(len(size), np.int64), np.zeros(len(size), np.int64)
            keys = np.zeros((len(live), COORDINATES), np.int64)
            if len(live):
                begin = at[:-1][live]
                id1[live], id2[live] = _identity(h, begin)
                for k in range(COORDINATES):
                    least = np.minimum.reduceat((h * _MULTIPLY[k] + _ADD[k]) >> U(32), begin)
                    keys[:, k] = least.astype(np.int64) | (k << 32)
            ends = np.zeros(len(size) + 1, np.int32)
            ends[1:] = np.cumsum(np.where(size > 0, COORDINATES, 0))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(size, pa.int64()), pa.array(id1), pa.array(id2),
                 pa.ListArray.from_arrays(pa.array(ends), pa.array(keys.reshape(-1)))],
                names=["doc_id", "n_shingles", "id1", "id2", "keys"])

    return run


def postings(classes: DataFrame) -> DataFrame:
    """key, class_id, weight: the rarest shared values of each class that shares enough, and how shared all of its values are."""
    tokens = classes.select("class_id", F.explode("keys").alias("key"))
    shared = tokens.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    ranked = (tokens.join(shared, "key").groupBy("class_id")
              .agg(F.sort_array(F.collect_list(F.struct("n", "key"))).alias("s"), F.sum("n").alias("weight"))
              .filter(F.size("s") >= MATCHES))
    return ranked.select("class_id", "weight", F.explode(F.slice(
        "s", F.lit(1), F.size("s") - MATCHES + 1)).alias("x")).select(F.col("x.key").alias("key"), "class_id", "weight")


def confirm(pairs: DataFrame, texts: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Of distinct pairs (a, b), those with 100 * intersection >= percent * union, on full sets.

    Texts (class_id, id1, text) meet in groups by b; a much used b is copied to several
    groups of about ``SALT`` partners each.
    """
    spark = pairs.sparkSession
    groups = pairs.groupBy("b").agg(F.ceil(F.count(F.lit(1)) / SALT).cast("int").alias("salts"))
    partners = pairs.join(groups, "b").select(
        F.col("a").alias("class_id"), F.col("b").alias("hub"), F.pmod(F.xxhash64("a"), F.col("salts")).alias("salt"))
    hubs = groups.select(F.col("b").alias("class_id"), F.col("b").alias("hub"),
                         F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts").cast("long") - 1)).alias("salt"))
    placed = partners.unionByName(hubs).join(texts, "class_id")
    n = 2 * partitions(spark)
    placed = placed.withColumn("bucket", F.pmod(F.xxhash64("hub", "salt"), F.lit(n)).cast("int"))

    def judge(pdf: pd.DataFrame) -> pd.DataFrame:
        h, at = shingle_sets(pa.array(pdf["text"], pa.string()), shingle)
        live = np.flatnonzero(np.diff(at))
        same = np.zeros(len(pdf), np.int64)
        if len(live):
            same[live] = _identity(h, at[:-1][live])[0]
        # Rows that share a doc_id may differ in text: only the class's own set counts.
        own = same == pdf["id1"].to_numpy()
        member, hub, salt = (pdf[c].to_numpy() for c in ("class_id", "hub", "salt"))
        heads = {(h_, s): i for i, (m, h_, s, o) in enumerate(zip(member.tolist(), hub.tolist(), salt.tolist(),
                                                                   own.tolist(), strict=True)) if m == h_ and o}
        linked = set()
        for i, (m, h_, s, o) in enumerate(zip(member.tolist(), hub.tolist(), salt.tolist(), own.tolist(),
                                              strict=True)):
            j = heads.get((h_, s))
            if m == h_ or not o or j is None:
                continue
            x, y = h[at[i]: at[i + 1]], h[at[j]: at[j + 1]]
            small, large = sorted((len(x), len(y)))
            if 100 * small < percent * large:
                continue
            common = len(np.intersect1d(x, y, assume_unique=True))
            if 100 * common >= percent * (small + large - common):
                linked.add((m, h_))
        return pd.DataFrame(sorted(linked), columns=["a", "b"], dtype="int64")

    return placed.groupBy("bucket").applyInPandas(judge, "a long, b long")


def _settle(shingle: int, percent: int):
    """Links between different components of each list (or pair of blocks of one) of a bucket.

    A member's shingles, looked up in the list's inverted index, give its intersection with every other member
    at once; one link to each other component is enough.
    """

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        h, at = shingle_sets(pa.array(pdf["text"], pa.string()), shingle)
        live = np.flatnonzero(np.diff(at))
        same = np.zeros(len(pdf), np.int64)
        if len(live):
            same[live] = _identity(h, at[:-1][live])[0]
        own = np.flatnonzero(same == pdf["id1"].to_numpy())
        ids, comp = pdf["class_id"].to_numpy(), pdf["component"].to_numpy()
        lists = pdf["list"].to_numpy()
        own = own[np.argsort(lists[own], kind="stable")]
        cuts = np.flatnonzero(np.r_[True, lists[own][1:] != lists[own][:-1], True]) if len(own) else [0]
        found = set()
        for i, j in zip(cuts[:-1], cuts[1:], strict=True):
            rows = own[i:j]
            names, inverse, count = np.unique(comp[rows], return_inverse=True, return_counts=True)
            if len(names) < 2:
                continue
            size = at[rows + 1] - at[rows]
            values = np.concatenate([h[at[r]: at[r + 1]] for r in rows])
            member = np.repeat(np.arange(len(rows)), size)
            order = np.argsort(values, kind="stable")
            values, member = values[order], member[order]
            for x in np.flatnonzero(inverse != count.argmax()).tolist():
                mine = h[at[rows[x]]: at[rows[x] + 1]]
                begin, end = np.searchsorted(values, mine, "left"), np.searchsorted(values, mine, "right")
                n = end - begin
                places = np.repeat(begin - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(n.sum())
                common = np.bincount(member[places], minlength=len(rows))
                linked = (100 * common >= percent * (size[x] + size - common)) & (inverse != inverse[x])
                partners = np.flatnonzero(linked)
                for y in partners[np.unique(inverse[partners], return_index=True)[1]].tolist():
                    pair = (int(ids[rows[x]]), int(ids[rows[y]]))
                    found.add((max(pair), min(pair)))
        return pd.DataFrame(sorted(found), columns=["a", "b"], dtype="int64")

    return run


def _open_lists(posted: DataFrame, grouped: DataFrame) -> DataFrame:
    """class_id, component, list: members of lists that hold several components, dealt in pairs of blocks."""
    labelled = (posted.select("key", "class_id").join(grouped.withColumnRenamed("node", "class_id"), "class_id", "left")
                .withColumn("component", F.coalesce("component", "class_id")))
    of = lambda seed: F.bit_xor(F.xxhash64(F.lit(seed), "class_id"))
    lists = (labelled.groupBy("key").agg(F.min("component").alias("least"), F.max("component").alias("most"),
                                         F.count(F.lit(1)).alias("n"), of(1).alias("s1"), of(2).alias("s2"))
             .filter("least <> most").groupBy("s1", "s2", "n").agg(F.min("key").alias("key")))
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("class_id"), blocks).cast("int")
    dealt = labelled.join(lists.select("key", "n"), "key").select(
        "class_id", "component", "key", own.alias("own"),
        F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other"))
    return dealt.select("class_id", "component", F.xxhash64(
        "key", F.least("own", "other"), F.greatest("own", "other")).alias("list"))


def near_duplicates(docs: DataFrame, shingle: int = 4, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: one row a document; component_id is its group's least doc_id."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    if distinct_ids(docs):
        return near_rows(docs, shingle, percent).select(
            "doc_id", "n_shingles", F.col("component").alias("component_id"),
            (F.col("component") == F.col("doc_id")).alias("kept"))
    docs = identified(docs)
    grouped = near_rows(docs.select(F.col("__id").alias("doc_id"), "text"), shingle, percent)
    # The least row's own doc_id, by a salted join: a group may hold a third of all rows.
    ids = docs.select(F.col("__id"), "doc_id")
    salted = grouped.withColumnRenamed("doc_id", "__id").withColumn("salt", F.pmod(F.xxhash64("__id"), F.lit(SALTS)))
    heads = grouped.select("component").distinct().join(
        ids.select(F.col("__id").alias("component"), F.col("doc_id").alias("component_id")), "component").withColumn(
            "salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    return salted.join(heads, ["component", "salt"]).join(ids, "__id").select(
        "doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def near_rows(rows: DataFrame, shingle: int = 4, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component of rows (doc_id, text) whose doc_ids differ; component is the group's least doc_id."""
    spark = rows.sparkSession
    signed = stored(rows.mapInArrow(_sign(shingle), SIGNED), "signed")
    sets = signed.filter("n_shingles > 0")
    ids = ["id1", "id2", "n_shingles"]
    least = stored(sets.groupBy(*ids).agg(F.min("doc_id").alias("class_id")), "classes")
    classes = stored(
        sets.join(least, ids).filter("doc_id = class_id").select("class_id", "id1", "n_shingles", "keys")
        .dropDuplicates(["class_id", "id1"]), "representatives")
    posted = stored(postings(classes), "postings")
    wanted = posted.select("class_id").distinct().join(classes.select("class_id", "id1"), "class_id")
    texts = stored(rows.join(wanted, rows["doc_id"] == wanted["class_id"]).select("class_id", "id1", "text"), "texts")

    hubs = posted.groupBy("key").agg(F.max(F.struct("weight", "class_id")).alias("hub"))
    pairs = stored(posted.join(hubs, "key").select(F.col("class_id").alias("a"), F.col("hub.class_id").alias("b"))
                   .filter("a <> b").distinct(), "pairs")
    links = stored(confirm(pairs, texts, shingle, percent), "links")
    n = 2 * partitions(spark)
    opened = _open_lists(posted, components(links)).join(texts, "class_id").withColumn(
        "bucket", F.pmod(F.col("list"), F.lit(n)).cast("int"))
    links = links.unionByName(stored(opened.groupBy("bucket").applyInPandas(
        _settle(shingle, percent), "a long, b long").distinct(), "links"))
    # Copies are no nodes: their class is, and they meet its component in one join by set.
    group = components(links)
    placed = least.join(group, F.col("class_id") == F.col("node"), "left").select(
        *ids, F.coalesce("component", "class_id").alias("component"))
    return signed.select("doc_id", *ids).join(placed, ids, "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component"))
