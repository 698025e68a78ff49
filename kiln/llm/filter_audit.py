"""How filters of a corpus interact: what each removes in every order they can run in.

A row's failures are one bit mask, so a table shrinks to a few weighted cells per part
(2^filters masks at most) before any order is looked at.  Each cell is folded across the
array of all orders with ``transform`` and ``aggregate``: filters! x filters structs (600 for
five), weighted by the cell and merged by elementwise sums over the cells of its part.  All
of it is DataFrame functions.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from itertools import permutations

from pyspark.sql import Column, DataFrame, functions as F

from kiln.session import checkpoint_dir

#: filters that can be audited: the orders grow with their factorial
MAX_FILTERS = 6

# --- fixed values: the five filters of the audit --------------------------------
MIN_WORDS = 100
MIN_DISTINCT_PERCENT = 80
MAX_CAPITALS_PERCENT = 10
SYMBOLS = "[#$%&*|]"
# ---------------------------------------------------------------------------------
_SPACES = " \t\n\x0b\x0c\r"


def text_failures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  part_col: str = "lang") -> DataFrame:
    """``doc_id, part, n, A, B, C, D, E``: the documents with the five failure conditions;
    ``n`` is how many rows are equal in id, part and text.

    A: under 100 words.  B: distinct words below 80 % of the words.  C: ``[A-Z]`` above 10 %
    of the code points.  D: holds one of ``#$%&*|``.  E: the text of a smaller id, table-wide.
    Words are runs of characters other than ``\\x20`` and ``\\x09``-``\\x0D``; a null text is
    empty and a null part is the empty string.  Texts are compared by SHA-256.  Rows with
    one id and one text are no copies of each other; a null id is neither smaller nor larger
    than another, so it fails E never and makes no row fail.  Whole texts are read once; long
    ones take time in proportion.  Other columns of ``docs`` are not read.  An empty table
    gives no rows.  The result is checkpointed: some 60 bytes a document.
    """
    checkpoint_dir(docs.sparkSession)
    text = F.coalesce(F.col(text_col), F.lit(""))
    cut = docs.select(
        F.col(id_col).alias("doc_id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
        F.unhex(F.sha2(text, 256)).alias("digest"),
        F.split(F.btrim(text, F.lit(_SPACES)), "[ \\t-\\r]+").alias("words"),
        (F.length(F.regexp_replace(text, "[^A-Z]+", "")) * 100
         > F.length(text) * MAX_CAPITALS_PERCENT).alias("C"),
        text.rlike(SYMBOLS).alias("D"))
    # an empty text is cut into one empty word
    counted = cut.select("doc_id", "part", "digest", "C", "D",
                         F.when(F.col("words")[0] == "", 0).otherwise(F.size("words")).alias("n_words"),
                         F.when(F.col("words")[0] == "", 0)
                         .otherwise(F.size(F.array_distinct("words"))).alias("n_distinct"))
    rows = (counted.select("doc_id", "part", "digest", (F.col("n_words") < MIN_WORDS).alias("A"),
                           (F.col("n_distinct") * 100 < F.col("n_words") * MIN_DISTINCT_PERCENT).alias("B"),
                           "C", "D")
            .groupBy("doc_id", "part", "digest", "A", "B", "C", "D")
            .agg(F.count(F.lit(1)).alias("n")).checkpoint())
    # joined on the id too: a text that a third of all rows share is spread over its ids
    first = (rows.groupBy("digest").agg(F.min("doc_id").alias("doc_id"))
             .withColumn("is_first", F.lit(True)))
    return rows.join(first, ["digest", "doc_id"], "left").select(
        "doc_id", "part", "n", "A", "B", "C", "D",
        (F.col("is_first").isNull() & F.col("doc_id").isNotNull()).alias("E"))


def with_labels(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """``rows`` of :func:`text_failures` with ``good`` and ``toxic``: how many of their ``n``
    documents ``labels`` marks by ``quality = 1`` and ``toxic = 1``.  Any of several labels of
    an id counts; a document without label or with null labels is neither."""
    marks = labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.max((F.col("quality") == 1).cast("int")).alias("q"), F.max((F.col("toxic") == 1).cast("int")).alias("t"))
    marked = rows.join(marks, "doc_id", "left")
    return marked.select(*rows.columns, *(
        F.when(F.col(c) == 1, F.col("n")).otherwise(F.lit(0)).alias(name)
        for c, name in (("q", "good"), ("t", "toxic"))))


def _fold(mask: Column, order: Column, sums: dict[str, Column]) -> Column:
    """The steps of one order for one cell: what the filter of each step does to it."""
    zero = F.lit(0).cast("long")

    def step(state: Column, bit: Column) -> Column:
        fails = mask.bitwiseAND(bit) != 0
        gone = mask.bitwiseAND(state["seen"]) != 0
        removed = fails & ~gone
        found = F.struct(
            bit.alias("bit"), F.when(~fails & ~gone, sums["n"]).otherwise(zero).alias("kept"),
            F.when(removed, sums["n"]).otherwise(zero).alias("removed"),
            F.when(fails & gone, sums["n"]).otherwise(zero).alias("redundant"),
            F.when(mask == bit, sums["n"]).otherwise(zero).alias("unique_fails"),
            *(F.when(removed, v).otherwise(zero).alias(f"{k}_lost") for k, v in sums.items() if k != "n"))
        return F.struct(state["seen"].bitwiseOR(bit).alias("seen"),
                        F.concat(state["steps"], F.array(found)).alias("steps"))

    names = ["kept", "removed", "redundant", "unique_fails", *(f"{k}_lost" for k in sums if k != "n")]
    fields = ", ".join(f"{c}: bigint" for c in names)
    start = F.struct(F.lit(0).alias("seen"),
                     F.array().cast(f"array<struct<bit: int, {fields}>>").alias("steps"))
    return F.aggregate(order, start, step, lambda state: state["steps"])


def interactions(rows: DataFrame, filters: Sequence[str], part: str = "part", n: str | None = None,
                 weights: Sequence[str] = ()) -> DataFrame:
    """``part, filter_order, step, kept, removed, redundant, unique_fails, <weight>_lost ..,
    shapley``: one row for each part, order of the ``filters`` and step.

    ``rows`` has a boolean column per filter (true: the row fails it; null: it does not),
    ``part``, optionally ``n`` (rows that one stands for) and ``weights`` (counts lost with a
    removed row).  Of a part's rows, ``kept`` are left after the step, ``removed`` go in it,
    ``redundant`` fail its filter but went before, ``unique_fails`` fail its filter only;
    ``shapley`` is what its filter removes, summed over all orders.  ``filter_order`` joins the
    names.  Every combination has a row, zeros included; parts are those of ``rows``, a null
    part is one of its own.  An empty table gives no rows.  At most ``MAX_FILTERS`` filters.
    """
    filters = list(filters)
    if not 0 < len(filters) <= MAX_FILTERS:
        raise ValueError(f"1 to {MAX_FILTERS} filters can be audited")
    orders = list(permutations(range(len(filters))))
    bits = F.from_json(F.lit(str([[1 << f for f in o] for o in orders])), "array<array<int>>")
    names = F.from_json(F.lit(json.dumps(["".join(filters[f] for f in o) for o in orders])), "array<string>")
    mask = sum((F.when(F.col(c), F.lit(1 << k)).otherwise(F.lit(0)) for k, c in enumerate(filters)), F.lit(0))
    one = F.lit(1) if n is None else F.col(n)
    cells = (rows.select(F.col(part).alias("part"), mask.alias("mask"), one.cast("long").alias("n"),
                         *(F.col(w).cast("long").alias(f"w_{w}") for w in weights))
             .groupBy("part", "mask").agg(F.sum("n").alias("n"),
                                          *(F.sum(f"w_{w}").alias(f"w_{w}") for w in weights)))
    sums = {"n": F.col("n"), **{w: F.coalesce(F.col(f"w_{w}"), F.lit(0).cast("long")) for w in weights}}
    folded = cells.select("part", F.flatten(
        F.transform(bits, lambda order: _fold(F.col("mask"), order, sums))).alias("steps"))
    # a part has a cell per mask at most, so the list is bounded
    listed = folded.groupBy("part").agg(F.collect_list("steps").alias("cells"))
    counts = ["kept", "removed", "redundant", "unique_fails", *(f"{w}_lost" for w in weights)]

    def plus(a: Column, b: Column) -> Column:
        return F.struct(a["bit"].alias("bit"), *((a[c] + b[c]).alias(c) for c in counts))

    merged = listed.select("part", F.aggregate(
        F.slice("cells", F.lit(2), F.size("cells")), F.col("cells")[0],
        lambda a, b: F.zip_with(a, b, plus)).alias("steps"))
    every = F.transform(F.lit([1 << k for k in range(len(filters))]), lambda bit: F.aggregate(
        F.filter("steps", lambda s: s["bit"] == bit), F.lit(0).cast("long"), lambda a, s: a + s["removed"]))
    rows_out = merged.select("part", every.alias("every"), F.posexplode("steps").alias("at", "s"))
    place = F.floor(F.col("at") / len(filters)).cast("int")
    return rows_out.select(
        "part", names[place].alias("filter_order"),
        (F.col("at") - place * len(filters) + 1).cast("int").alias("step"),
        *(F.col(f"s.{c}").alias(c) for c in counts),
        F.col("every")[F.log2(F.col("s.bit")).cast("int")].alias("shapley"))
