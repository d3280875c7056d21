"""Secret scan with corpus-wide ownership frequency.

Base rules find candidate credentials in every whole text. Each candidate's
value is hashed, and the hashes are aggregated over the corpus: how many
distinct repositories and owners carry the same value. A value is a copied example if
a share of ``OWNER_SHARE`` of all owners of the corpus, and ``LEAST_OWNERS`` at least, carry it
and no owner has more than a share of ``OWNER_MOST`` of its repositories. The others look live:
those of few owners, in however many repositories, and those that stand mostly with one owner.
The verdicts go back to each document as spans of the kinds live and example beside the base spans.

Defined cases: a null or empty text has no findings; a text of any length is scanned whole; equal rows count once per
(repository, owner) and each get the same result; a null owner or repository is
a value of its own; an empty table gives an empty result. Extra columns are
ignored.
"""

from __future__ import annotations

import hashlib
import re
import sys

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillmart.llm.common import dealt_anew, distinct_name, stage, text_arrays

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# The kinds in their listed order, the base patterns, least lengths.
KINDS = ("assign", "access", "hex")
ASSIGN = rb"""(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = rb"AKIA[A-Z0-9]+"
HEX = rb"[0-9a-f]{16,}"
LEAST = {"assign": 12, "access": 18, "hex": 16}
VERDICTS = ("example", "live")
# A real key gets around by a copied passage or a shared project; only what many owners carry,
# none of them most of it, counts as an example.
OWNER_SHARE = 0.1
LEAST_OWNERS = 3
OWNER_MOST = 0.5
KEYWORDS = (b"passw", b"secret", b"token", b"apikey", b"api_key")

SCHEMA = ("doc_id long, repo string, owner string, n_assign long, n_access long, n_hex long, "
          "base_sha256 string, spans string, "
          "found array<struct<kind:string,start:int,stop:int,value:string>>")


def find_secrets(text: bytes) -> list[tuple[int, int, int, bytes]]:
    """Base findings (start, kind index, end, value) of one UTF-8 text, in byte positions."""
    found = []
    low = text.lower()
    if any(k in low for k in KEYWORDS):
        for m in re.finditer(ASSIGN, text):
            if len(m[1]) >= LEAST["assign"]:
                found.append((m.start(), 0, m.end(), m[1]))
    if b"AKIA" in text:
        found += [(m.start(), 1, m.end(), m[0]) for m in re.finditer(ACCESS, text) if len(m[0]) >= LEAST["access"]]
    found += [(m.start(), 2, m.end(), m[0]) for m in re.finditer(HEX, text)]
    return sorted(found)


def _points(text: bytes, found: list) -> list[tuple[int, int, int, bytes]]:
    """The same findings in code points."""
    if not found or text.isascii():
        return found
    cuts = sorted({p for start, _, stop, _ in found for p in (start, stop)})
    at, points, before = 0, {}, 0
    for p in cuts:
        at += len(text[before:p].decode())
        points[p] = at
        before = p
    return [(points[start], kind, points[stop], value) for start, kind, stop, value in found]


def scan(documents: DataFrame, text_col: str = "text", id_col: str = "doc_id",
         repo_col: str = "doc_id", owner_col: str = "source") -> DataFrame:
    """Base findings of each row, with the hashed value of every finding."""

    def per_partition(batches):
        for rows, texts in text_arrays(batches):
            out = {k: [] for k in ("n_assign", "n_access", "n_hex", "base_sha256", "spans", "found")}
            for text in texts.cast(pa.binary()).to_pylist():
                found = _points(text, find_secrets(text))
                spans = ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b, _ in found)
                for k, name in enumerate(KINDS):
                    out[f"n_{name}"].append(sum(f[1] == k for f in found))
                out["base_sha256"].append(hashlib.sha256(spans.encode()).hexdigest())
                out["spans"].append(spans)
                out["found"].append([{"kind": KINDS[k], "start": a, "stop": b,
                                      "value": hashlib.sha256(v).hexdigest()} for a, k, b, v in found])
            yield pa.RecordBatch.from_arrays([
                rows["doc_id"].combine_chunks(), rows["repo"].combine_chunks(), rows["owner"].combine_chunks(),
                pa.array(out["n_assign"], pa.int64()), pa.array(out["n_access"], pa.int64()),
                pa.array(out["n_hex"], pa.int64()), pa.array(out["base_sha256"], pa.string()),
                pa.array(out["spans"], pa.string()),
                pa.array(out["found"], pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()),
                                                           ("stop", pa.int32()), ("value", pa.string())]))),
            ], names=["doc_id", "repo", "owner", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "found"])

    return documents.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
        F.col(repo_col).cast("string").alias("repo"), F.col(owner_col).cast("string").alias("owner"),
    ).mapInArrow(per_partition, SCHEMA)


def ownership(found: DataFrame, owners: int, share: float = OWNER_SHARE, least: int = LEAST_OWNERS,
              most: float = OWNER_MOST) -> DataFrame:
    """Per hashed value: distinct repositories, distinct owners and the verdict, in a corpus of ``owners``.

    Counted in three partial aggregations, so a value that a third of all rows
    carry is reduced before each shuffle.
    """
    pairs = found.select("repo", "owner", F.explode("found.value").alias("value"))
    per_repo = pairs.groupBy("value", "owner", "repo").agg(F.count(F.lit(1)).alias("n"))
    per_owner = per_repo.groupBy("value", "owner").agg(F.count(F.lit(1)).alias("repos"), F.sum("n").alias("n"))
    total = per_owner.groupBy("value").agg(
        F.sum("repos").alias("n_repos"), F.count(F.lit(1)).alias("n_owners"), F.sum("n").alias("n_uses"),
        F.max("repos").alias("most_repos"))
    copied = (F.col("n_owners") >= max(least, share * owners)) & (F.col("most_repos") <= most * F.col("n_repos"))
    return total.withColumn("live", ~copied)


def count_owners(documents: DataFrame, owner_col: str = "source") -> int:
    """Distinct owners of the corpus (a null one counts): one read of that column."""
    return documents.select(F.col(owner_col).cast("string").alias("owner")).distinct().count()


def secret_scan(spark: SparkSession, documents: DataFrame, owner_col: str = "source", rule: dict | None = None,
                **columns) -> DataFrame:
    """Findings of each row and how many of its values look live or are copied examples.

    ``spans``: the base spans and, at the same places, each finding's verdict (live or example), by
    start and then kind in the order of ``KINDS`` and ``VERDICTS``. ``rule``: options of ``ownership``.
    """
    found = stage(spark, scan(documents, owner_col=owner_col, **columns), "secrets")
    verdicts = ownership(found, count_owners(documents, owner_col), **(rule or {})).select(dealt_anew("value"), "n_owners", "live")
    values = found.where(F.size("found") > 0).select("doc_id", "repo", "owner", F.col("spans").alias("base"),
                                                     F.explode("found").alias("f")).distinct()
    kinds = F.array(*[F.lit(k) for k in KINDS])
    named = lambda spans: F.array_join(F.transform(
        F.array_sort(spans), lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")
    span = lambda place, kind: F.struct(
        F.col("f.start").alias("start"), place.cast("int").alias("place"), F.col("f.stop").alias("stop"), kind.alias("kind"))
    own = span(F.array_position(kinds, F.col("f.kind")), F.col("f.kind"))
    verdict = span(F.when(F.col("live"), len(KINDS) + 2).otherwise(len(KINDS) + 1),
                   F.when(F.col("live"), F.lit(VERDICTS[1])).otherwise(F.lit(VERDICTS[0])))
    per_row = (values.join(verdicts, F.col("f.value") == verdicts["value"])
               .groupBy("doc_id", "repo", "owner", "base")
               .agg(F.sum(F.col("live").cast("long")).alias("n_live"),
                    F.sum((~F.col("live")).cast("long")).alias("n_shared"),
                    F.max("n_owners").alias("most_owners"),
                    named(F.concat(F.collect_list(own), F.collect_list(verdict))).alias("spans"),
                    named(F.collect_list(F.when(F.col("live"), own))).alias("live_spans")))
    a, b = found.withColumnRenamed("spans", "base").alias("a"), per_row.alias("b")
    same = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in ("doc_id", "repo", "owner", "base")]
    return a.join(b, on=same, how="left").select(
        "a.doc_id", "a.n_assign", "a.n_access", "a.n_hex", "a.base_sha256",
        F.coalesce("b.spans", F.lit("")).alias("spans"),
        F.coalesce("b.n_live", F.lit(0)).cast("long").alias("n_live"),
        F.coalesce("b.n_shared", F.lit(0)).cast("long").alias("n_shared"),
        F.coalesce("b.most_owners", F.lit(0)).cast("long").alias("most_owners"),
        F.coalesce("b.live_spans", F.lit("")).alias("live_spans"))


def mask_live(spark: SparkSession, documents: DataFrame, rule: dict | None = None,
              text_col: str = "text", id_col: str = "doc_id", repo_col: str = "doc_id",
              owner_col: str = "source", mask: str = "[secret]") -> DataFrame:
    """``documents`` with the live-looking findings of ``text_col`` replaced by ``mask``.

    Copied examples stay. Rows without a finding pass through where they are read;
    only rows with findings are shuffled, to meet the verdicts on their values. The texts are
    scanned once: rows with their findings are written first.
    """
    schema = documents.schema
    mark = distinct_name(documents, "found")
    kind = T.ArrayType(T.StructType().add("start", "integer").add("stop", "integer").add("value", "string"))

    def find(batches):
        for rows, texts in text_arrays(batches, column=text_col):
            found = [[{"start": a, "stop": b, "value": hashlib.sha256(v).hexdigest()}
                      for a, _, b, v in find_secrets(t)] for t in texts.cast(pa.binary()).to_pylist()]
            yield from rows.append_column(mark, pa.array(found, pa.list_(pa.struct(
                [("start", pa.int32()), ("stop", pa.int32()), ("value", pa.string())])))).to_batches()

    marked = stage(spark, documents.mapInArrow(find, T.StructType([*schema, T.StructField(mark, kind)])), "marked")
    clean = marked.where(F.size(mark) == 0).drop(mark)
    dirty = marked.where(F.size(mark) > 0)
    owners = dirty.select(F.col(repo_col).cast("string").alias("repo"), F.col(owner_col).cast("string").alias("owner"),
                          F.col(mark).alias("found"))
    live = ownership(owners, count_owners(documents, owner_col), **(rule or {})).where("live").select(dealt_anew("value"))
    own = dirty.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("hash"), F.explode(f"{mark}.value").alias("value"))
    per_row = (own.distinct().join(live, "value").groupBy("id", "hash")
               .agg(F.collect_set("value").alias("values")))  # of one text
    a, b = dirty.alias("a"), per_row.alias("b")
    joined = a.join(b, F.col(f"a.{id_col}").eqNullSafe(F.col("b.id"))
                    & (F.xxhash64(F.col(f"a.{text_col}")) == F.col("b.hash")), "left").select(
        *(F.col(f"a.{c}") for c in documents.columns),
        F.filter(f"a.{mark}", lambda f: F.coalesce(F.array_contains("b.values", f["value"]), F.lit(False))).alias(mark))

    def replace(batches):
        for rows, texts in text_arrays(batches, column=text_col):
            out = []
            for text, found in zip(texts.cast(pa.binary()).to_pylist(), rows[mark].to_pylist()):
                parts, at = [], 0
                for f in found:
                    if f["start"] >= at:
                        parts += [text[at:f["start"]], mask.encode()]
                    at = max(at, f["stop"])
                out.append((b"".join(parts) + text[at:]).decode())
            k = rows.column_names.index(text_col)
            yield from rows.set_column(k, rows.field(k), pa.array(out, rows.field(k).type)).drop_columns([mark]).to_batches()

    return clean.unionByName(joined.mapInArrow(replace, schema))
