"""Line dedup by a segment-partition edit join, in DataFrame operations only.

A line is its words (runs without space or the controls from tab to carriage return). It is
removed if an earlier line (smaller doc_id, or further up in the document) has the same
words, or differs by few inserted, deleted or replaced units. Units are words for lines of
``MIN_WORDS`` words or more, which may differ by ``edits``; a shorter line, or one written
without spaces, is its characters (words joined by one space), and may differ by one edit for
each ``PER_EDIT`` characters of the shorter line, ``edits`` at most. Every line with a word is
compared for equality; lines of words are not compared with lines of characters. Lines are
judged on the input.

1. Equal lines fall together by 96-bit hashes, combined map-side, so a hot line is one row.
2. A line of L units that may differ by e is cut into ``e + 1`` even segments; if another line is
   within e, it holds one of them unchanged, near its place. Each line is indexed under (unit, L,
   segment number, segment) and probes, for each length L it could match, the few places that the
   edits left and right of a segment allow. Keys meet in an equi-join that also compares
   unit parities: an edit changes at most two of 31, so other pairs are not even emitted.
3. Lists of many lines are compared block by block, and only each line's count of near ones leaves a block (``near_links``).
4. Pairs are verified by banded bit-parallel edit distance: a band of ``2 * edits + 1`` diagonals
   is one integer of vertical differences, updated once a unit by a fold. Units that both lines begin or end
   with go first: they cost nothing in any cheapest way from one line to the other.

Defined results: null text is one empty line; each row is a document of its own: rows that share a doc_id
are ordered by text, rows without one come last; other columns are kept as they are, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.shared import identified, ordered_id, partitions, stored

EDITS, MIN_WORDS, MIN_EXACT, PER_EDIT, WIDE, BLOCK = 2, 8, 1, 8, 16, 256
#: Indexed keys of one partition that are held as a hash table, at about 100 bytes each; of more, they are sorted.
HASHED = 1 << 18
#: More than a text can have lines.
LINES = 1 << 31


def _split_lines(docs: DataFrame) -> DataFrame:
    split = F.split(F.coalesce(F.col("text"), F.lit("")), "\n", -1)
    return docs.select(ordered_id().alias("doc_id"), F.posexplode(split).alias("line_no", "line"))


def _words(line: Column) -> Column:
    """The line's words; one kind of space first, so that the split needs no pattern. Few lines hold another kind."""
    other = F.contains(line, F.lit("\t")) | F.contains(line, F.lit("\x0b")) | F.contains(line, F.lit("\x0c")) | F.contains(line, F.lit("\r"))
    spaced = F.when(other, F.translate(line, "\t\x0b\x0c\r", "    ")).otherwise(line)
    return F.array_remove(F.split(spaced, " ", -1), "")


def lines(docs: DataFrame, min_exact: int = MIN_EXACT) -> DataFrame:
    """doc_id, line_no (from 0), words, n, h1, h2 of the lines that are compared."""
    # Lines without a word go by a pattern, which stops at the first word; a filter on n would move below the split and
    # split every line twice.
    some = _split_lines(docs).filter(F.col("line").rlike(r"[^\x20\x09-\x0D]") if min_exact > 0 else F.lit(True))
    found = some.select("doc_id", "line_no", _words(F.col("line")).alias("words")).withColumn("n", F.size("words"))
    return ((found.filter(F.col("n") >= min_exact) if min_exact > 1 else found)
            .withColumn("h1", F.xxhash64("words")).withColumn("h2", F.hash("words")))


def _units(min_words: int) -> Column:
    """What a line's edits are counted in: its words, or its characters if it has fewer than ``min_words``."""
    return F.when(F.size("words") >= min_words, F.col("words")).otherwise(F.split(F.array_join("words", " "), ""))


def _segment(length: Column, i: int, parts: int) -> tuple[Column, Column]:
    """Place (from 0) and size of segment i of a line of ``length`` units: even parts, the longer ones last."""
    q, r = F.floor(length / parts).cast("int"), (length % parts).cast("int")
    longer = i - (parts - r)
    return i * q + F.greatest(longer, F.lit(0)), q + F.when(longer >= 0, 1).otherwise(0)


def allowed(length: Column, worded: Column, edits: int) -> Column:
    """Edits that a line of ``length`` units may differ by."""
    return F.when(worded, edits).otherwise(F.least(F.floor(length / PER_EDIT).cast("int"), F.lit(edits)))


def _key(e: int, i: int, length: Column, start: Column, size: Column) -> Column:
    return F.hash(F.col("worded"), F.lit(e * 16 + i), length, F.slice(F.col("codes"), start + 1, size))


def index_keys(edits: int) -> Column:
    keys = [F.array().cast("array<int>")]
    for e in range(1, edits + 1):
        keys.append(F.array(*[_key(e, i, F.col("m"), *_segment(F.col("m"), i, e + 1)) for i in range(e + 1)]))
    may = allowed(F.col("m"), F.col("worded"), edits)
    chosen = F.when(may == edits, keys[edits])
    for e in range(edits):
        chosen = chosen.when(may == e, keys[e])
    return chosen


def probe_keys(edits: int) -> Column:
    """Keys of the indexed lines, of the same or fewer units, that this line may be near to.

    Segment i of the other line has at most i edits before it and ``e - i`` after it if the
    segments before it are the ones hit first; that bounds its shift from both sides. Places where no such line
    fits hold null: taking them out here, by a lambda, would leave all keys to evaluation without generated code.
    """
    def keys_of(every: range, keep: Callable[[Column, Column, int, int], Column]) -> list[Column]:
        keys = []
        for fewer in range(edits + 1):
            length = F.col("m") - fewer
            for e in every:
                for i in range(e + 1):
                    start, size = _segment(length, i, e + 1)
                    for shift in range(max(-i, fewer - (e - i)), min(i, fewer + e - i) + 1):
                        if fewer <= e:
                            keys.append(keep(_key(e, i, length, start + shift, size), start + shift, fewer, e))
        return keys

    def fits(key: Column, start: Column, fewer: int, e: int) -> Column:
        length = F.col("m") - fewer
        return F.when((allowed(length, F.col("worded"), edits) == e) & (length > 0) & (start >= 0), key)

    if not edits:
        return F.array().cast("array<int>")
    # Most lines may differ by all edits whatever the length sought, and every place fits: nothing is asked of a key there.
    plain = F.array(*keys_of(range(edits, edits + 1), lambda key, start, fewer, e: key))
    return F.when(F.col("m") >= (PER_EDIT + 1) * edits, plain).otherwise(F.array(*keys_of(range(1, edits + 1), fits)))


def parity() -> Column:
    """31 parities of the line's units by hash, as a number that is not negative; a 32nd is left out."""
    # A shift takes the last five bits of the hash.
    return F.aggregate("codes", F.lit(0), lambda s, code: s.bitwiseXOR(
        F.call_function("shiftleft", F.lit(1), code))).bitwiseAND(F.lit(2**31 - 1))


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is evaluated once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _cut(longer: Column, shorter: Column) -> Column:
    """The two arrays, as a and b, without the units that both begin with."""
    same = F.zip_with(longer, shorter, lambda a, b: a.eqNullSafe(b))
    first = F.array_position(same, F.lit(False)).cast("int")  # 0: the arrays are equal
    rest = lambda units: F.slice(units, F.greatest(first, F.lit(1)), F.when(first == 0, 0).otherwise(F.size(units)))
    return F.struct(rest(longer).alias("a"), rest(shorter).alias("b"))


def _distance(longer: Column, shorter: Column, edits: int) -> Column:
    """Edits between two unit arrays, the first at least as long and longer by ``edits`` at most; above ``edits``, only that.

    Column j of the edit matrix is seen at rows j - edits .. j + edits (bit 0 the topmost). ``vp`` and ``vn``
    hold where the value rises or falls to the next row; rows above the matrix fall towards
    it. On the diagonal that ends in the last cell the value grows by one wherever
    a step down it costs something.
    """
    width = 2 * edits + 1
    band = (1 << width) - 1
    extra = F.size(longer) - F.size(shorter)

    def matches(w: Column, j: Column) -> Column:
        """Bits of the rows whose word equals column j's."""
        bits = F.lit(0)
        for k in range(width):
            bits = bits + F.when(F.get(longer, j + (k - edits)) == w, 1 << k).otherwise(0)
        return bits

    masks = F.transform(shorter, matches)
    state = F.struct(F.lit(band - ((1 << (edits + 1)) - 1)).alias("vp"), F.lit((1 << (edits + 1)) - 1).alias("vn"),
                     extra.alias("d"))

    def column(s: Column, mask: Column) -> Column:
        vp = F.shiftright(s["vp"], 1).bitwiseOR(F.lit(1 << (width - 1)))
        vn = F.shiftright(s["vn"], 1)
        x = mask.bitwiseOR(vn)
        d0 = ((x.bitwiseAND(vp) + vp).bitwiseXOR(vp)).bitwiseOR(x).bitwiseAND(F.lit(band))

        def rest(t: Column) -> Column:
            hp = t["vn"].bitwiseOR(F.bitwise_not(t["vp"].bitwiseOR(t["d0"])))
            hn = t["vp"].bitwiseAND(t["d0"])
            above_p = F.shiftleft(hp, 1).bitwiseOR(F.lit(1))
            above_n = F.shiftleft(hn, 1)
            on = F.call_function("shiftright", t["d0"], edits + extra).bitwiseAND(F.lit(1))
            return F.struct(
                above_n.bitwiseOR(F.bitwise_not(above_p.bitwiseOR(t["d0"]))).bitwiseAND(F.lit(band)).alias("vp"),
                above_p.bitwiseAND(t["d0"]).bitwiseAND(F.lit(band)).alias("vn"), (s["d"] + 1 - on).alias("d"))

        return F.element_at(F.transform(F.array(F.struct(vp.alias("vp"), vn.alias("vn"), d0.alias("d0"))), rest), 1)

    return F.aggregate(masks, state, column, lambda s: s["d"])


def within(longer: Column, shorter: Column, edits: int, most: Column | None = None) -> Column:
    """Whether two unit arrays, the first at least as long, are within ``edits`` edits, and within ``most`` if given."""
    extra = F.size(longer) - F.size(shorter)
    most = F.lit(edits) if most is None else most
    # Lines as long as each other mostly differ by replaced units alone; counting those is far cheaper than the fold.
    replaced = F.size(F.filter(F.zip_with(longer, shorter, lambda a, b: a != b), lambda other: other))
    unequal = lambda a, b: _let(_cut(a, b), lambda t: _let(
        _cut(F.reverse(t["a"]), F.reverse(t["b"])), lambda u: _distance(u["a"], u["b"], edits)))
    return (extra <= edits) & (((extra == 0) & (replaced <= most)) | (unequal(longer, shorter) <= most))


def _verified(pairs: DataFrame, texts: DataFrame, edits: int) -> DataFrame:
    """Of distinct pairs (a, b) of hashes, a of as many units as b or more, those whose lines are near; with fa and fb,
    where the lines occur first."""
    x, y = F.col("x"), F.col("y")
    both = (pairs.join(texts.select(F.col("h1").alias("a"), "worded", F.col("units").alias("x"), F.col("f").alias("fa")), "a")
            .join(texts.select(F.col("h1").alias("b"), F.col("worded").alias("also"), F.col("units").alias("y"),
                               F.col("f").alias("fb")), "b")
            .filter("worded = also"))
    return both.filter(within(x, y, edits, allowed(F.size(y), F.col("worded"), edits))).select("a", "b", "fa", "fb")


def _compared(edits: int) -> Column:
    """Lines of two blocks against each other: for each line of either, how many of the other are near, and whether an
    earlier one is. A pair counts under the first list that its lines share, and not at all if they share a short one."""
    def cell(a: Column, b: Column) -> Column:
        # Places where nothing fits are nulls among the keys sought.
        shared = F.array_min(F.array_intersect(a["probing"], b["long"])) == F.col("key")
        near = ((F.bit_count(a["p"].bitwiseXOR(b["p"])) <= 2 * edits) & _ahead(a["m"], a["h1"], b["m"], b["h1"])
                & (a["worded"] == b["worded"]) & shared & ~F.coalesce(F.arrays_overlap(a["probing"], b["short"]), F.lit(False))
                & within(a["units"], b["units"], edits, allowed(b["m"], b["worded"], edits)))
        return F.when(near, F.when(b["f"] < a["f"], 1).otherwise(2)).otherwise(0)

    return F.transform("seekers", lambda a: F.transform("members", lambda b: cell(a, b)))


def _ahead(m: Column, h1: Column, other_m: Column, other_h1: Column) -> Column:
    """Of two lines one seeks the other: the longer one, of equally long ones that of the smaller hash."""
    return (m > other_m) | ((m == other_m) & (h1 < other_h1))


def _long_links(held: DataFrame, seeking: DataFrame, found: DataFrame, edits: int, block: int) -> DataFrame:
    """h1, near, links of the lines of long lists. Lists are cut into blocks of about ``block`` lines, and each block of
    seekers meets each block of members in a row of its own: pairs are compared inside that row and only counted."""
    n = partitions(held.sparkSession)
    size = lambda df, n: df.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias(n))
    sizes = size(held, "nb").join(size(seeking, "na"), "key")
    members = held.groupBy("h1").agg(F.collect_set("key").alias("long"))

    def blocks(rows: DataFrame, name: str, own: str, other: str, line: Column) -> DataFrame:
        part = F.pmod(F.hash("h1"), F.col(own)).alias(own[1] + "_block")
        dealt = (rows.join(sizes, "key").groupBy("key", part, other).agg(F.collect_list(line).alias(name))
                 .withColumn("ab"[own == "na"] + "_block", F.explode(F.sequence(F.lit(0), F.col(other) - 1))).drop(other))
        # Small rows, long work: a stated number, so that they are not put together by their bytes.
        return dealt.repartition(n, "key", "a_block", "b_block")

    by_member = blocks(held.join(members, "h1").join(found, "h1"), "members", "nb", "na", F.struct(
        "h1", "f", "p", "m", "worded", "units", "long", F.array_except("indexed", "long").alias("short")))
    by_seeker = blocks(seeking.join(found, "h1"), "seekers", "na", "nb", F.struct(
        "h1", "f", "p", "m", "worded", "units", "probing"))
    met = by_seeker.join(by_member, ["key", "a_block", "b_block"]).select("seekers", "members", _compared(edits).alias("cells"))
    ones = F.transform("seekers", lambda a, i: F.struct(
        a["h1"].alias("h1"), F.exists(F.get("cells", i), lambda c: c == 1).alias("near"),
        F.size(F.filter(F.get("cells", i), lambda c: c > 0)).cast("long").alias("links")))
    others = F.transform("members", lambda b, j: F.struct(
        b["h1"].alias("h1"), F.exists("cells", lambda row: F.get(row, j) == 2).alias("near"),
        F.size(F.filter("cells", lambda row: F.get(row, j) > 0)).cast("long").alias("links")))
    return met.select(F.explode(F.filter(F.concat(ones, others), lambda x: x["links"] > 0)).alias("x")).select("x.*")


def near_links(distinct: DataFrame, docs: DataFrame, edits: int, min_words: int, wide: int | None = None,
               block: int | None = None) -> DataFrame:
    """h1, near (an earlier line is near), links (near lines, all of them) of every line that has a near one.

    ``distinct`` has each line once with its keys and where it occurs first, from which the texts of candidates are
    read. Under a key with ``wide`` (``WIDE``) indexed lines or fewer, candidates are pairs in rows of their own. Longer lists are
    compared block by block (``BLOCK``) and only counts leave a block, so that rows stay few where thousands of lines are near each other.
    """
    wide, block = WIDE if wide is None else wide, block or BLOCK
    kept = distinct.filter("size(indexed) > 0")
    # Parities and length in one number: there are many keys, and every column of theirs is shuffled.
    shape = F.shiftleft(F.col("m").cast("long"), 31).bitwiseOR(F.col("p").cast("long"))
    side = lambda keys, h1, pm: kept.select(F.explode(keys).alias("key"), F.col("h1").alias(h1), shape.alias(pm)).filter(
        "key is not null")
    indexed, probing = side("indexed", "b", "pb"), side("probing", "a", "pa")
    length = lambda pm: F.shiftright(pm, 31)
    parities = F.col("pa").bitwiseXOR(F.col("pb")).bitwiseAND(F.lit(2**31 - 1))
    close = _ahead(length("pa"), F.col("a"), length("pb"), F.col("b")) & (F.bit_count(parities) <= 2 * edits)
    # Lists are counted once; long ones are few, so that the others are all but those.
    long_keys = stored(indexed.groupBy("key").agg(F.count(F.lit(1)).alias("members"))
                       .filter(F.col("members") > wide).select("key"), "long-keys")
    short = indexed.join(long_keys, "key", "left_anti")
    # A hash table cannot spill, but its size is known here: a key of a short list has few rows, so that keys fall evenly.
    if distinct.count() * (edits + 1) <= HASHED * partitions(distinct.sparkSession):
        short = short.hint("shuffle_hash")
    pairs = stored(probing.join(short, "key").filter(close).select("a", "b").distinct(), "pairs")
    in_long = lambda keys: kept.select(F.explode(keys).alias("key"), "h1").join(long_keys, "key").distinct()
    held, seeking = stored(in_long("indexed"), "long-lists"), stored(in_long("probing"), "seekers")
    with_long = held.select("h1").unionByName(seeking.select("h1")).distinct()
    keyed = stored(kept.join(with_long, "h1").select("h1", "p", "m", "indexed", "probing"), "long-lines")

    wanted = (pairs.select(F.col("a").alias("h1")).unionByName(pairs.select(F.col("b").alias("h1")))
              .unionByName(keyed.select("h1")).distinct())
    at = kept.select("h1", "f").join(wanted, "h1").select("h1", "f.doc_id", "f.line_no")
    # Texts travel whole, a row a document, and only those that hold a candidate are split; written as units, so that the
    # fold below reads columns.
    by_doc = at.groupBy("doc_id").agg(F.collect_list(F.struct("line_no", "h1")).alias("wanted"))
    held_lines = docs.select(ordered_id().alias("doc_id"), "text").join(by_doc, "doc_id").select(
        "doc_id", "wanted", F.split(F.coalesce(F.col("text"), F.lit("")), "\n", -1).alias("lines"))
    read = held_lines.select("doc_id", F.explode(F.transform("wanted", lambda w: F.struct(
        w["h1"].alias("h1"), w["line_no"].alias("line_no"), F.get(F.col("lines"), w["line_no"]).alias("line")))).alias("x")).select(
            "x.h1", F.struct("doc_id", "x.line_no").alias("f"), "x.line")
    texts = stored(read.filter(F.xxhash64(_words(F.col("line"))) == F.col("h1"))  # rows may share a doc_id
                   .dropDuplicates(["h1"]).select("h1", "f", _words(F.col("line")).alias("words"))
                   .select("h1", "f", (F.size("words") >= min_words).alias("worded"), _units(min_words).alias("units")), "texts")

    sides = _verified(pairs, texts, edits)
    one = F.lit(1).cast("long").alias("links")
    ends = sides.select(F.explode(F.array(F.struct(F.col("a").alias("h1"), (F.col("fa") > F.col("fb")).alias("near"), one),
                                          F.struct(F.col("b").alias("h1"), (F.col("fb") > F.col("fa")).alias("near"), one))).alias("x"))
    # Written one after the other: as one plan, all their stages are planned and compiled on the driver at once.
    by_pair = stored(ends.select("x.*"), "pair-links")
    by_block = stored(_long_links(held, seeking, keyed.join(texts, "h1"), edits, block), "long-links")
    return by_pair.unionByName(by_block).groupBy("h1").agg(
        F.max("near").alias("near"), F.sum("links").alias("links"))


def _places(low: int | None, high: int | None) -> tuple[Column, Column]:
    """A line's place as one number, for doc_ids from ``low`` to ``high``, and doc_id and line_no of the number ``place``.

    It is a long where every place fits one, else a decimal, which is far slower to add and compare.
    """
    if low is None or (low >= -2**32 and high < 2**32):
        return F.col("doc_id") * F.lit(LINES) + F.col("line_no"), F.struct(
            F.shiftright("place", 31).alias("doc_id"),
            F.col("place").bitwiseAND(F.lit(LINES - 1)).cast("int").alias("line_no"))
    rest = F.expr(f"pmod(place, {LINES}BD)")
    return F.col("doc_id").cast("decimal(19,0)") * F.lit(LINES).cast("decimal(10,0)") + F.col("line_no"), F.struct(
        F.expr(f"(place - pmod(place, {LINES}BD)) div {LINES}BD").alias("doc_id"), rest.cast("int").alias("line_no"))


def removed_lines(docs: DataFrame, edits: int = EDITS, min_words: int = MIN_WORDS,
                  min_exact: int = MIN_EXACT) -> DataFrame:
    """doc_id (null as the greatest long), removed (line numbers), n_near (removed for a near copy), n_links (near lines), of
    the documents that have a line which occurs again or is near another."""
    # Parsed and hashed once, for all uses below.
    found = stored(lines(docs, min_exact).select(
        "doc_id", "line_no", "h1", "h2", (F.col("n") >= min_words).alias("worded"), _units(min_words).alias("units"))
        # Each unit is hashed once; keys and parities are made of the hashes.
        .select("*", F.size("units").alias("m"), F.transform("units", lambda u: F.hash(u)).alias("codes")).select(
            "doc_id", "line_no", "h1", "h2", "m", index_keys(edits).alias("indexed"),
            probe_keys(edits).alias("probing"), parity().alias("parity")), "lines")
    # Equal lines are one: their keys are equal too. With the place as one number the aggregation needs no sort.
    place, first_place = _places(*found.agg(F.min("doc_id"), F.max("doc_id")).first())
    by_line = found.groupBy("h1", "h2", "m", "indexed", "probing", F.col("parity").alias("p")).agg(
        F.min(place).alias("place"), F.count(F.lit(1)).alias("n"))
    distinct = stored(by_line.select(
        "h1", "h2", "m", "indexed", "probing", "p", first_place.alias("f"), "n"), "distinct-lines")
    near = stored(near_links(distinct, docs, edits, min_words), "near-lines")
    first = distinct.select("h1", "h2", F.col("f").alias("first"), "n")
    flagged = first.join(near, "h1", "left").filter("n > 1 or links > 0").drop("n")  # all others stay, without a link
    is_first = (F.col("first.doc_id") == F.col("doc_id")) & (F.col("first.line_no") == F.col("line_no"))
    is_near = F.coalesce("near", F.lit(False))
    return (found.select("doc_id", "line_no", "h1", "h2").join(flagged, ["h1", "h2"])
            .select("doc_id", "line_no", (~is_first | is_near).alias("gone"), is_near.alias("near"),
                    F.coalesce("links", F.lit(0)).alias("links"))
            .groupBy("doc_id").agg(
                F.array_sort(F.collect_set(F.when(F.col("gone"), F.col("line_no")))).alias("removed"),
                F.size(F.collect_set(F.when(F.col("near"), F.col("line_no")))).cast("long").alias("n_near"),
                F.sum("links").alias("n_links")))


def dedup_lines(docs: DataFrame, edits: int = EDITS, min_words: int = MIN_WORDS,
                min_exact: int = MIN_EXACT) -> DataFrame:
    """The rows of ``docs`` with the kept lines as text, and the number of lines removed as ``__n_removed``."""
    names = docs.columns
    docs = identified(docs.select("doc_id", "text", F.struct(*names).alias("row")))
    removed = removed_lines(docs.select(F.col("__id").alias("doc_id"), "text"), edits, min_words, min_exact).select(
        F.col("doc_id").alias("__id"), "removed")
    split = F.split("text", "\n", -1)
    gone = F.coalesce("removed", F.array().cast("array<int>"))
    kept = F.transform(F.array_except(F.sequence(F.lit(0), F.size(split) - 1), gone), lambda i: F.get(split, i))
    text = F.when(F.size(gone) > 0, F.array_join(kept, "\n")).otherwise(F.col("text"))
    return docs.join(removed, "__id", "left").select(
        *[text.alias(c) if c == "text" else F.col("row").getField(c).alias(c) for c in names if c != "__n_removed"],
        F.size(gone).alias("__n_removed"))


def report(docs: DataFrame) -> DataFrame:
    """doc_id, n_lines, n_removed, n_near, n_links, removed: a row for each document."""
    text = F.coalesce(F.col("text"), F.lit(""))
    # A line more than there are line breaks: far cheaper than splitting every text again.
    n_lines = (F.octet_length(text) - F.octet_length(F.replace(text, F.lit("\n"), F.lit(""))) + 1).cast("long")
    docs = identified(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    rows = docs.select("__id", "doc_id", n_lines.alias("n_lines"))
    found = removed_lines(docs.select(F.col("__id").alias("doc_id"), "text")).withColumnRenamed("doc_id", "__id")
    removed = F.coalesce("removed", F.array().cast("array<int>"))
    return rows.join(found, "__id", "left").select(
        "doc_id", "n_lines", F.size(removed).cast("long").alias("n_removed"),
        F.coalesce("n_near", F.lit(0)).alias("n_near"), F.coalesce("n_links", F.lit(0)).alias("n_links"),
        removed.alias("removed"))
