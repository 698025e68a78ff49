"""Benchmark decontamination with built-in DataFrame functions only.

Item-sized windows of the documents get a 64-bit SimHash of their word shingles.  The
fingerprints of windows and items are cut into ``radius + 1`` blocks, and an equality
join on the blocks finds every pair within ``radius`` bits (one of the blocks is then
the same).  A fingerprint is of the distinct shingles; the weighted Jaccard similarity of the
shingles themselves, each weighted by how often it occurs, decides.

Windows that cannot be the best of their pair (document, item) are not fingerprinted.
Shingles that a window has and the item lacks count for nothing, so a window as similar
as asked has at least ``similarity / (1 + similarity)`` of both numbers of shingles in
places whose shingle the item has.  Of the starts with so many, those are taken at which
the shared weight is higher than one start before and not lower than one start after:
the best window, the first of equals, is always one of them, however the item's parts
are ordered and spaced in the document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from kiln.session import checkpoint_dir

SHINGLE_WORDS = 5
SIMILARITY = 0.8
#: bits of two fingerprints that may differ.  At similarity 0.8 the shingles of two
#: windows of one size agree to 8/9; of 64 bits 9.7 differ then (deviation 2.9).
RADIUS = 23
#: rows up to which a table (of items, or of windows found) is sent to all tasks
BROADCAST_ROWS = 200_000

_SPACE = r"[\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    """Lower-cased words; null for a null text."""
    return F.array_remove(F.split(F.lower(text), _SPACE), "")


def bounded(df: DataFrame) -> DataFrame:
    """A written table, to be broadcast if its rows, counted, are few."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def _shingles(w: Column, n: int) -> Column:
    """Shingles of a word array that is not empty; fewer than ``n`` words are one."""
    return F.transform(F.sequence(F.lit(1), F.greatest(F.size(w) - (n - 1), F.lit(1))),
                       lambda i: F.concat_ws(" ", F.slice(w, i, F.lit(n))))


def _with_fingerprint(df: DataFrame, shingles: str) -> DataFrame:
    """Adds ``fp``: bit j is set if it is set in over half of the distinct shingles' hashes.
    A shingle that repeats has one vote, or a few such would decide every bit."""
    return (df.withColumn("hashes", F.transform(F.array_distinct(shingles), lambda s: F.xxhash64(s)))
            .withColumn("fp", F.expr("""    -- never null: a test for null would run it twice
                coalesce(aggregate(sequence(0, 63), 0L, (acc, j) -> acc | if(
                    2 * size(filter(hashes, h -> (shiftrightunsigned(h, j) & 1L) = 1L)) > size(hashes),
                    shiftleft(1L, j), 0L)), 0L)"""))
            .drop("hashes"))


def _blocks(radius: int) -> list[tuple[int, int]]:
    """(offset, width) of ``radius + 1`` blocks of 64 bits."""
    n = radius + 1
    cuts = [64 * k // n for k in range(n + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def _block_keys(fp: str, radius: int) -> str:
    """SQL of the array of block keys: the block's number above, its bits below."""
    return "array(" + ", ".join(
        f"{k << 32}L | (shiftrightunsigned({fp}, {at}) & {(1 << width) - 1}L)"
        for k, (at, width) in enumerate(_blocks(radius))) + ")"


def _best_starts() -> str:
    """SQL of the array of starts to take, from ``p`` (shared places in order: ``at``, hash
    ``h``, ``times`` that the item has it), ``size`` (shingles of a window) and ``need``."""
    def adds(x: str, at: str, j: str) -> str:
        """Whether shingle ``x`` weighs in beside the ``size - 1`` shingles from start
        ``at`` that end before place number ``j`` of ``p``."""
        return (f"size(filter(slice(p, greatest({j} - size + 2, 1), least({j}, size - 1)), "
                f"y -> y.at >= {at} and y.h = {x}.h)) < {x}.times")

    def rises(j: str) -> str:
        """Whether the window that ends at place number ``j`` shares more than the one before."""
        start = f"(p[{j}].at - size + 1)"
        before = (f"filter(slice(p, greatest({j} - size + 1, 1), least({j}, size)), "
                  f"x -> x.at = {start} - 1)")
        return f"({adds(f'p[{j}]', start, j)} and not exists({before}, x -> {adds('x', start, j)}))"

    enough = "j >= need - 1 and p[j].at - p[greatest(j - need + 1, 0)].at < size and p[j].at >= size - 1"
    follows = "j + 1 < size(p) and p[least(j + 1, size(p) - 1)].at = p[j].at + 1"
    taken = (f"filter(sequence(0, size(p) - 1), j -> {enough} and {rises('j')} "
             f"and not ({follows} and {rises('least(j + 1, size(p) - 1)')}))")
    return f"""array_distinct(concat(
        if(p[need - 1].at < size, array(0), cast(array() as array<int>)),
        transform({taken}, j -> p[j].at - size + 1)))"""


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id",
                 text_col: str = "text", item_col: str = "item_id", item_text: str = "text",
                 shingle_words: int = SHINGLE_WORDS, similarity: float = SIMILARITY,
                 radius: int = RADIUS) -> DataFrame:
    """``id_col, item_col, start_word, n_words, similarity, differing_bits``: for each
    document and each benchmark item that one of its windows repeats, the most similar
    window (the first of equals).

    A window has as many words as the item (a shorter document is one window).  The words
    of a text with fewer than a shingle are its one shingle: such an item is found in
    documents of the same words, not inside of longer ones.  Texts without a word, null
    texts and rows without id match nothing; rows of equal id count as one document with
    several texts, equal rows as one.  Whole texts of any length are read.  Empty tables
    give no rows.  Other columns are not read, whatever their names.
    """
    spark = docs.sparkSession
    checkpoint_dir(spark)
    n = shingle_words
    items = (benchmark.select(F.col(item_col).alias("item"), F.xxhash64(item_text).alias("item_key"),
                              words(F.col(item_text)).alias("iw"))
             .where(F.col("item").isNotNull()).distinct())
    texts = (docs.select(F.col(id_col).alias("doc"), F.xxhash64(text_col).alias("doc_key"),
                         words(F.col(text_col)).alias("w"))
             .where(F.col("doc").isNotNull()))

    def hashed(df: DataFrame, w: str, *keep: str) -> DataFrame:
        """Shingle hashes by place, from word hashes, and the number of shingles; places past
        the end of a text shorter than a shingle are null, and so add nothing to its hash."""
        each = F.transform(F.col(w), lambda x: F.xxhash64(x))
        df = df.select(*keep, F.greatest(F.size(w) - (n - 1), F.lit(1)).alias("size"), each.alias("wh"))
        df = df.select(*keep, "size", "wh", F.posexplode(F.slice("wh", F.lit(1), F.col("size")))
                       .alias("at", "first"))
        return df.select(*keep, "size", "at", F.xxhash64("first", *(
            F.get("wh", F.col("at") + k) for k in range(1, n))).alias("h"))

    # per pair the places whose shingle the item has, and how often the item has it
    known = (hashed(items, "iw", "item", "item_key")
             .groupBy("item", "item_key", F.col("size").alias("item_size"), "h")
             .agg(F.count("*").cast("int").alias("times")).checkpoint())
    shared = hashed(texts, "w", "doc", "doc_key").join(bounded(known), "h")
    size = F.least("item_size", "size")                # shingles of a window
    need = F.ceil(similarity * (size + F.col("item_size")) / (1 + similarity) - 1e-9).cast("int")
    places = (shared.groupBy("doc", "doc_key", "item", "item_key", "item_size", size.alias("size"),
                             need.alias("need"))
              .agg(F.array_sort(F.collect_set(F.struct("at", "h", "times"))).alias("p"))
              .where(F.size("p") >= F.col("need")))
    starts = (places.select("doc", "doc_key", "item", "item_key", (F.col("item_size") + (n - 1)).alias("m"),
                            F.explode(F.expr(_best_starts())).alias("start"))
              .distinct().checkpoint())

    windows = (texts.join(bounded(starts), ["doc", "doc_key"])
               .select("doc", "item", "item_key", "start", F.slice("w", F.col("start") + 1, F.col("m")).alias("ww"))
               .withColumn("ws", _shingles(F.col("ww"), n)))
    windows = _with_fingerprint(windows, "ws")
    targets = _with_fingerprint(items.where(F.size("iw") > 0)
                                .withColumn("item_s", _shingles(F.col("iw"), n)), "item_s")

    # multi-index: an equal block for every pair within the radius
    probes = windows.select("doc", "item", "item_key", "start", "ws", F.size("ww").alias("n_words"),
                            F.col("fp").alias("wfp"), F.explode(F.expr(_block_keys("fp", radius))).alias("key"))
    index = targets.select("item", "item_key", "item_s", F.col("fp").alias("ifp"),
                           F.explode(F.expr(_block_keys("fp", radius))).alias("key"))
    near = F.bit_count(F.col("wfp").bitwiseXOR(F.col("ifp")))
    # of the equal blocks of a pair only the first goes on
    first = F.expr(f"array_position(zip_with({_block_keys('wfp', radius)}, "
                   f"{_block_keys('ifp', radius)}, (a, b) -> a = b), true) - 1")
    candidates = (probes.join(index, ["item", "item_key", "key"])
                  .where(near <= radius)
                  .where(F.shiftright("key", 32) == first))

    # exact weighted similarity of the shingles
    def times(array: str, s: Column) -> Column:
        return F.size(F.filter(F.col(array), lambda x: x == s))

    common = F.aggregate(F.array_distinct("ws"), F.lit(0), lambda acc, s: acc + F.least(
        times("ws", s), times("item_s", s)))
    scored = (candidates.withColumn("common", common)
              .withColumn("similarity", F.col("common") / (F.size("ws") + F.size("item_s") - F.col("common")))
              .where(F.col("similarity") >= similarity))
    best = F.max_by(F.struct("start", "n_words", "similarity", near.alias("bits")),
                    F.struct("similarity", -F.col("start")))
    return (scored.groupBy("doc", "item").agg(best.alias("b"))
            .select(F.col("doc").alias(id_col), F.col("item").alias(item_col),
                    F.col("b.start").alias("start_word"), F.col("b.n_words").alias("n_words"),
                    F.col("b.similarity").alias("similarity"),
                    F.col("b.bits").cast("int").alias("differing_bits")))
