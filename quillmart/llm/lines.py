"""Line dedup: a line that stands in several documents stays in one of them.

Every line's key (blanks stripped at both ends, ASCII capitals folded) is hashed to
128 bits; distinct documents are counted for each hash. Hashes of at least ``min_docs``
documents lose all their lines but those of the smallest document id. Only hashes,
ids and positions are shuffled for the decision; the text meets the positions of its
dropped lines once and is put together again where it then lies.

Hot lines: distinct pairs (hash, document) are counted in two steps, each combined
before its shuffle, and the way back is a join of two plain shuffles, whose hot keys
Spark splits.

Defined cases: a null text is an empty one, and an empty text is one empty line; a
text of any length is split whole; lines with short keys always stay; rows with
equal ids count as one document (a line keeps its places in all of them); rows without an
id are together one document, which keeps a line only if no other holds it; repeated
rows give a result each; an empty table gives an empty result. Other columns are
ignored.
"""

from __future__ import annotations

import hashlib
import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmart.llm.common import text_arrays

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLANKS = " \t\n\x0b\x0c\r"
CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MIN_CHARS = 10
MIN_DOCS = 2


def versions(documents: DataFrame) -> DataFrame:
    """(doc_id, version, text): rows of equal id and version have equal texts, so positions found
    for one hold for all, whenever and however the table is read."""
    text = F.coalesce("text", F.lit(""))
    return documents.select("doc_id", F.xxhash64(text).alias("version"), text.alias("text"))


def keyed_lines(documents: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(doc_id, version, pos, h1, h2): each line whose key has ``min_chars`` code points or more."""
    lines = versions(documents).select("doc_id", "version", F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))
    keys = lines.select("doc_id", "version", "pos",
                        F.translate(F.btrim("line", F.lit(BLANKS)), CAPITALS, SMALL).alias("key"))
    return keys.where(F.char_length("key") >= min_chars).select(
        "doc_id", "version", "pos", F.xxhash64(F.lit(1), "key").alias("h1"), F.xxhash64(F.lit(2), "key").alias("h2"))


def shared_keys(lines: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """(h1, h2, keeper): hashes in at least ``min_docs`` documents and the smallest id among these."""
    pairs = lines.select("h1", "h2", "doc_id").distinct()
    counted = pairs.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n_docs"), F.min("doc_id").alias("keeper"))
    # the hashes as expressions of their own (as in common.dealt_anew; these are never null): the join
    # then stands between two plain shuffles, whose hot keys Spark splits
    again = [F.col(h).bitwiseXOR(F.lit(0).cast("long")).alias(h) for h in ("h1", "h2")]
    return counted.where(F.col("n_docs") >= min_docs).select(*again, "keeper")


def dropped_positions(documents: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """(doc_id, version, gone): the positions (from 0) of the lines that each text loses."""
    lines = keyed_lines(documents, min_chars)
    lost = (lines.join(shared_keys(lines, min_docs), ["h1", "h2"])
            .where(~F.col("doc_id").eqNullSafe(F.col("keeper"))))
    return lost.groupBy("doc_id", "version").agg(F.collect_set("pos").alias("gone"))


def _with_positions(documents: DataFrame, min_chars: int, min_docs: int) -> DataFrame:
    rows, lost = versions(documents).alias("r"), dropped_positions(documents, min_chars, min_docs).alias("l")
    same = F.col("r.doc_id").eqNullSafe(F.col("l.doc_id")) & (F.col("r.version") == F.col("l.version"))
    return rows.join(lost, same, "left").select("r.doc_id", "r.text", "l.gone")


def _kept(texts: list[bytes], gone: list) -> list[bytes]:
    """Each text without the lines at its positions."""
    out = []
    for text, lost in zip(texts, gone):
        if lost:
            lines = text.split(b"\n")
            stays = np.ones(len(lines), bool)
            stays[lost] = False
            text = b"\n".join([lines[i] for i in np.flatnonzero(stays)])
        out.append(text)
    return out


def dedup_lines(documents: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS,
                digest: bool = False) -> DataFrame:
    """Per row: doc_id, n_lines (before), n_dropped and ``kept``, the text of the lines that stay
    (with ``digest`` its sha256 as kept_sha256 instead)."""
    value = "kept_sha256" if digest else "kept"
    rows = _with_positions(documents, min_chars, min_docs)
    id_type = rows.schema["doc_id"].dataType.simpleString()

    def assemble(batches):
        for table, texts in text_arrays(batches):
            raw, gone = texts.cast(pa.binary()).to_pylist(), table["gone"].to_pylist()
            kept = _kept(raw, gone)
            out = [hashlib.sha256(k).hexdigest() for k in kept] if digest else [k.decode() for k in kept]
            yield pa.RecordBatch.from_arrays([
                table["doc_id"].combine_chunks(), pa.array([t.count(b"\n") + 1 for t in raw], pa.int64()),
                pa.array([len(g or ()) for g in gone], pa.int64()), pa.array(out, pa.string())],
                names=["doc_id", "n_lines", "n_dropped", value])

    return rows.mapInArrow(assemble, f"doc_id {id_type}, n_lines long, n_dropped long, {value} string")


ORACLE = r"""
WITH lines AS (
  SELECT doc_id, rid, unnest(parts) AS line, unnest(range(len(parts))) AS pos
  FROM (SELECT doc_id, row_number() OVER () AS rid, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents)
), keyed AS (
  SELECT doc_id, rid, pos, line,
         translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM lines
), shared AS (
  SELECT k, min(doc_id) AS keeper FROM keyed WHERE length(k) >= 10
  GROUP BY k HAVING count(DISTINCT doc_id) >= 2
), marked AS (
  SELECT keyed.*, shared.k IS NOT NULL AND keyed.doc_id <> shared.keeper AS gone
  FROM keyed LEFT JOIN shared ON keyed.k = shared.k
)
SELECT min(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY rid
"""
