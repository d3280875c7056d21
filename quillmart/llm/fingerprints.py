"""Document fingerprints: invertible Bloom lookup sketches of paragraphs.

A text is the set of its paragraphs' 64-bit digests (a paragraph is a line; what is longer
than 256 characters is cut after its sentences, a piece that is still longer by its
content: see ``CUTS``). A sketch has three
tables of cells; a digest is added to one cell of each: a count, the XOR of
digests and the XOR of check values. Subtracting one version's cells from
another's leaves the digests in which they differ, and peeling recovers them:
a cell that holds one digest gives it away, it is taken out of its other cells,
and so on. If cells remain, that pair alone is tried again with a larger sketch, until all
are recovered; the recovered digests of each side are returned as their number and XOR.

Everything is DataFrame and SQL functions. The table of digests is bucketed, so
the cells of a document are made, subtracted and peeled in one task without
another shuffle.

Defined cases: texts of any length are taken whole; a null text is an empty one, with one empty paragraph; equal
texts have equal fingerprints and likeness 1; the order and number of equal
paragraphs do not matter; null ids sort first; rows of one id are in order of
their text, and every row is answered; a single document is its own neighbour;
an empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import math
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillmart.llm.common import shuffle_partitions
from quillmart.session import scratch_path

BASE_CELLS = 4  # in each of the three tables of a fingerprint
LONG_LINE = 256
# Where a piece of over LONG_LINE characters is cut, one after the other while pieces are still longer:
# after sentences, after those of other scripts, after words that end in h, l or y, then in e, t or a,
# then in h, l or y before other signs, at every blank,
# and after some frequent characters of scripts without blanks.
CUTS = (r"(?<=[.!?]) ", "(?<=[。！？；…])", "(?<=[hly]) ", "(?<=[eta]) ",
        "(?<=[hly][^a-z]) |(?<=[hly][^a-z]{2}) |(?<=[hly][^a-z]{3}) ", " ", "(?<=[的是了，、])")
ROUNDS = 2          # of the three tables, for a sketch sized to the sets
PARTS = 3           # ranges of documents for each shuffle partition
MOST_RETRIES = 24
PAIRS_SENT = 1_000_000  # keys of failed pairs (some 16 bytes each) that are broadcast at most
ROW = ["part", "rn"]


def _cut_by(pattern: str):
    return lambda x: F.when(F.length(x) > LONG_LINE, F.split(x, pattern)).otherwise(F.array(x))


def paragraphs(text: Column) -> Column:
    """Distinct digests of a text's paragraphs."""
    pieces = F.split(text, "\n")
    for cut in CUTS:
        pieces = F.flatten(F.transform(pieces, _cut_by(cut)))
    return F.array_distinct(F.transform(pieces, lambda x: F.xxhash64(x)))


def _cell(key: Column, table: int, cells: Column, seed: int) -> Column:
    return (F.lit(table) * cells + F.pmod(F.xxhash64(key, F.lit(1000 * seed + table)), cells)).cast("int")


def _check(key: Column, seed: int) -> Column:
    return F.xxhash64(key, F.lit(-1 - seed))


def _sum_cells(rows: DataFrame, keys: list[str]) -> DataFrame:
    return rows.groupBy(*keys, "cell", "found").agg(
        F.sum("cnt").alias("cnt"), F.bit_xor("ks").alias("ks"), F.bit_xor("hs").alias("hs"),
        F.max("cells").alias("cells"))


def difference(pairs: DataFrame, keys: list[str], cells: Column, seed: int) -> DataFrame:
    """Cells of sketch(a) - sketch(b) for each row of ``pairs`` (keys, a, b: arrays of digests).

    One row per cell that is not empty: cell, count, XOR of digests, XOR of checks.
    """
    signed = pairs.select(*keys, cells.cast("int").alias("cells"), F.explode(F.concat(
        F.transform("a", lambda x: F.struct(x.alias("k"), F.lit(1).cast("long").alias("sign"))),
        F.transform("b", lambda x: F.struct(x.alias("k"), F.lit(-1).cast("long").alias("sign"))))).alias("e"))
    keyed = signed.select(*keys, "cells", F.col("e.k").alias("k"), F.col("e.sign").alias("sign"))
    placed = keyed.select(*keys, "cells", "k", "sign", F.explode(F.array(
        *[_cell(F.col("k"), t, F.col("cells"), seed) for t in range(3)])).alias("cell"))
    return _not_empty(_sum_cells(placed.select(
        *keys, "cell", F.lit(0).cast("long").alias("found"), F.col("sign").alias("cnt"), F.col("k").alias("ks"),
        _check(F.col("k"), seed).alias("hs"), "cells"), keys))


def _not_empty(rows: DataFrame) -> DataFrame:
    return rows.where((F.col("cell") < 0) | (F.col("cnt") != 0) | (F.col("ks") != 0) | (F.col("hs") != 0))


def peel(rows: DataFrame, keys: list[str], seed: int, keep: bool = False, rounds: int = ROUNDS) -> DataFrame:
    """Take out what the cells give away. Rows left with cell >= 0 were not recovered; recovered
    digests are rows with cell -1 (only in a) and -2 (only in b), counted in ``cnt``, with their
    XOR in ``ks`` and with ``keep`` one row per digest (``found``).

    One table at a time: a digest is in one cell of each table, so no two cells of
    a step give away the same one.
    """
    for step in range(3 * rounds):
        table = step % 3
        lone = ((F.col("cell") >= 0) & (F.floor(F.col("cell") / F.col("cells")) == table)
                & (F.abs("cnt") == 1) & (F.col("hs") == _check(F.col("ks"), seed)))
        same = F.struct("cell", "found", "cnt", "ks", "hs")
        taken = [F.struct(_cell(F.col("ks"), t, F.col("cells"), seed).alias("cell"), F.lit(0).cast("long").alias("found"),
                          (-F.col("cnt")).alias("cnt"), F.col("ks"), F.col("hs")) for t in range(3) if t != table]
        given = F.struct(F.when(F.col("cnt") > 0, -1).otherwise(-2).cast("int").alias("cell"),
                         (F.col("ks") if keep else F.lit(0).cast("long")).alias("found"),
                         F.lit(1).cast("long").alias("cnt"), F.col("ks").alias("ks"), F.lit(0).cast("long").alias("hs"))
        moved = rows.select(*keys, "cells", F.explode(
            F.when(lone, F.array(*taken, given)).otherwise(F.array(same))).alias("m")).select(*keys, "cells", "m.*")
        rows = _not_empty(_sum_cells(moved, keys))
    return rows


def _outcome(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Per pair: did cells remain, and of the digests on one side only their number and XOR."""
    side = lambda cell, c: F.when(F.col("cell") == cell, F.col(c)).otherwise(F.lit(0).cast("long"))
    return rows.groupBy(*keys).agg(
        F.max((F.col("cell") >= 0).cast("int")).alias("left"),
        F.sum(side(-1, "cnt")).alias("n_a"), F.sum(side(-2, "cnt")).alias("n_b"),
        F.bit_xor(side(-1, "ks")).alias("x_a"), F.bit_xor(side(-2, "ks")).alias("x_b"))


def _renamed(pairs: DataFrame, keys: list[str]) -> tuple[DataFrame, list[str], dict[str, str]]:
    """Keys under names that cannot clash with those of cells, and the way back."""
    inner = [f"key_{i}" for i in range(len(keys))]
    return (pairs.select(*(F.col(k).alias(i) for k, i in zip(keys, inner)), "a", "b"), inner, dict(zip(inner, keys)))


def differences(spark: SparkSession, pairs: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, n_a, n_b, x_a, x_b): number and XOR of the digests on one side only, for each row of
    ``pairs`` (keys, a, b).

    First with the base sketch; pairs that it can't recover, and only these, with one sized to the
    two sets, doubled with new hash functions until every pair is recovered. Pairs without
    difference have no row.
    """
    pairs, keys, names = _renamed(pairs, keys)
    fit = (F.lit(8) + F.size("a") + F.size("b")).cast("int")
    open_pairs, answers = pairs, []
    for retry in range(MOST_RETRIES):
        if retry:
            tried = _outcome(peel(difference(open_pairs, keys, fit * (1 << (retry - 1)), retry), keys, retry), keys)
        else:
            tried = _outcome(peel(difference(pairs, keys, F.lit(BASE_CELLS), 0), keys, 0, rounds=1), keys)
        path = scratch_path(spark, "differences")
        tried.write.parquet(path)
        done = spark.read.schema(tried.schema).parquet(path)
        answers.append(done.where("left = 0").drop("left"))
        failed = done.where("left = 1").select(*keys)
        count = failed.limit(PAIRS_SENT + 1).count()
        if not count:
            return reduce(DataFrame.unionByName, answers).withColumnsRenamed(names)
        # few pairs (checked) go to where the digests lie; else both sides are shuffled
        open_pairs = pairs.join(F.broadcast(failed) if count <= PAIRS_SENT else failed, keys, "left_semi")
    raise RuntimeError(f"sketches of {MOST_RETRIES} sizes failed")


def recovered(pairs: DataFrame, keys: list[str], cells: int, seed: int = 0) -> DataFrame:
    """The differing digests themselves with sketches of 3 x ``cells``: (keys, whole, only_a, only_b).

    ``whole`` is false where cells remained: the lists are then incomplete and a
    larger sketch is due.
    """
    pairs, keys, names = _renamed(pairs, keys)
    rows = peel(difference(pairs, keys, F.lit(cells), seed), keys, seed, keep=True)
    return rows.groupBy(*keys).agg(
        (F.max(F.col("cell")) < 0).alias("whole"),
        F.sort_array(F.collect_list(F.when(F.col("cell") == -1, F.col("found")))).alias("only_a"),
        F.sort_array(F.collect_list(F.when(F.col("cell") == -2, F.col("found")))).alias("only_b")).withColumnsRenamed(names)


def sketch_text(rows: DataFrame, keys: list[str], digests: str, cells: int = BASE_CELLS) -> DataFrame:
    """(keys, fingerprint): the sketch of a set of digests, its cells in order as count:XOR:check in hex."""
    made = difference(rows.select(*keys, F.col(digests).alias("a"), F.array().cast("array<bigint>").alias("b")),
                      keys, F.lit(cells), 0)
    by_cell = F.map_from_entries(F.collect_list(F.struct("cell", F.concat_ws(
        ":", F.lower(F.hex("cnt")), F.lower(F.lpad(F.hex("ks"), 16, "0")),
        F.lower(F.lpad(F.hex(F.col("hs").bitwiseAND(0xFFFFFFFF)), 8, "0"))))))
    return made.groupBy(*keys).agg(by_cell.alias("m")).select(*keys, F.array_join(F.transform(
        F.sequence(F.lit(0), F.lit(3 * cells - 1)), lambda c: F.coalesce(F.element_at("m", c), F.lit("-"))), ",")
        .alias("fingerprint"))


def _part(cuts: list, value: Column) -> Column:
    """How many of the sorted ``cuts`` lie below ``value``: by groups of cuts, then within one group."""
    if not cuts:
        return F.lit(0)
    step = max(1, math.isqrt(len(cuts)))
    groups = [cuts[i: i + step] for i in range(0, len(cuts), step)]
    as_array = lambda xs: F.array(*[F.lit(x).cast("long") for x in xs])
    below = lambda xs: F.size(F.filter(xs, lambda c: c < value))
    group = F.size(F.filter(as_array([g[-1] for g in groups]), lambda c: c < value))
    inner = F.coalesce(F.get(F.array(*[as_array(g) for g in groups]), group), F.array().cast("array<bigint>"))
    return F.when(value.isNull(), 0).otherwise(F.least(group * step + below(inner), F.lit(len(cuts)))).cast("int")


def with_next(spark: SparkSession, documents: DataFrame, parts: int) -> DataFrame:
    """(part, rn, doc_id, text, next_text): each row with the text of the next one in descending id
    order, the last with the first.

    Ids are cut into ``parts`` ranges of equal numbers of documents. A row's next
    is behind it in its own range, but for a range's first row: to that, the last
    row of the range below (of the highest range for the lowest) is handed.
    """
    ids = documents.select("doc_id")
    cuts = ids.agg(F.percentile_approx("doc_id", [i / parts for i in range(1, parts)] or [0.5],
                                       100 * parts)).head()[0] or []
    rows = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"),
                            _part(sorted(set(cuts)) if parts > 1 else [], F.col("doc_id")).alias("part"))
    last = rows.groupBy("part").agg(F.max("doc_id").alias("doc_id"))  # a row for each range
    order = Window.orderBy("part")
    to = last.select("doc_id", F.coalesce(F.lead("part").over(order), F.min("part").over(
        order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("to"))
    handed = (rows.alias("r").join(F.broadcast(to.alias("t")), F.col("r.doc_id").eqNullSafe(F.col("t.doc_id")))
              .groupBy("t.to").agg(F.max("r.text").alias("text"))
              .select(F.lit(None).cast("long").alias("doc_id"), "text", F.col("to").alias("part"), F.lit(0).alias("own")))
    w = Window.partitionBy("part").orderBy("own", F.col("doc_id").asc_nulls_first(), "text")
    both = rows.withColumn("own", F.lit(1)).unionByName(handed)
    return both.select("part", F.row_number().over(w).alias("rn"), "own", "doc_id", "text",
                       F.lag("text").over(w).alias("next_text")).where("own = 1").drop("own")


def fingerprint_edits(spark: SparkSession, documents: DataFrame) -> DataFrame:
    """Each document, its edited text (the last half replaced by the start of the next document)
    and its next document: fingerprints, likenesses (shared paragraphs / all paragraphs) and
    the recovered digests, as number:XOR of those lost and number:XOR of those new (empty: none)."""
    parts = PARTS * shuffle_partitions(spark)
    rows = with_next(spark, documents.select(F.col("doc_id").cast("long"), "text"), parts)
    half = F.floor(F.length("text") / 2).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), F.length("text") - half),
                      F.substring(F.col("next_text"), F.lit(1), half))
    digests = rows.select("part", "rn", "doc_id", F.length("text").cast("long").alias("n_chars"),
                          paragraphs(F.col("text")).alias("own"), paragraphs(F.col("next_text")).alias("next"),
                          edited.alias("edited")).select(
        "part", "rn", "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "own", "next",
        paragraphs(F.col("edited")).alias("edited"))
    digests = digests.select("*", *(F.size(c).alias(f"n_{c}") for c in ("own", "edited", "next")))
    name = f"digests_{uuid.uuid4().hex}"
    digests.write.bucketBy(parts, "part").option("path", scratch_path(spark, "digests")).saveAsTable(name)
    held = spark.table(name)

    def pairs(other: str, k: int) -> DataFrame:
        return held.select(*ROW, F.lit(k).alias("pair"), F.col("own").alias("a"), F.col(other).alias("b"))

    differ = differences(spark, pairs("edited", 0).unionByName(pairs("next", 1)), [*ROW, "pair"])
    of = lambda k, c: F.max(F.when(F.col("pair") == k, F.col(c)))
    digest = lambda c: F.lower(F.lpad(F.hex(c), 16, "0"))
    named = F.concat_ws(":", "n_a", digest("x_a"), "n_b", digest("x_b"))
    per_row = differ.select(*ROW, "pair", (F.col("n_a") + F.col("n_b")).alias("differ"), named.alias("recovered")).groupBy(*ROW).agg(
        of(0, "differ").alias("d0"), of(1, "differ").alias("d1"), of(0, "recovered").alias("r0"), of(1, "recovered").alias("r1"))
    own = sketch_text(held, ROW, "own")
    new = sketch_text(held, ROW, "edited").withColumnRenamed("fingerprint", "edited_fingerprint")

    def likeness(other: str, d: str) -> Column:
        both, differ = F.col("n_own") + F.col(f"n_{other}"), F.coalesce(F.col(d), F.lit(0))
        return ((both - differ) / (both + differ)).cast("double")

    return held.join(per_row, ROW, "left").join(own, ROW).join(new, ROW).select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        likeness("edited", "d0").alias("near_edited"), likeness("next", "d1").alias("near_next"),
        F.col("n_own").alias("n_paragraphs"), F.coalesce("r0", F.lit("")).alias("recovered_edited"),
        F.coalesce("r1", F.lit("")).alias("recovered_next"))
