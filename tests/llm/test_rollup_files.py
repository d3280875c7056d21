"""Files that a commit of the token ledger writes."""

import glob

from quillmart.llm.rollup import TokenLedger


def test_commit_writes_a_file_per_bucket_not_per_task_and_bucket(spark, tmp_path, monkeypatch):
    held = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "11")
    try:
        changes = spark.range(2000).selectExpr(
            "id AS doc_id", "'s' AS source", "'l' AS lang", "'v' AS tokenizer_version", "1L AS n_tokens", "'insert' AS op", "0L AS seq")
        ledger = TokenLedger(spark, str(tmp_path / "ledger"), buckets=7)
        monkeypatch.setattr(ledger.states, "vacuum", lambda keep=1: 0)
        assert ledger.commit(1, changes)
        assert [tuple(r) for r in ledger.totals().collect()] == [("s", "l", "v", 2000, 2000)]
        assert len(glob.glob(str(tmp_path / "ledger" / "data-*" / "_bucket=*" / "*.parquet"))) == 14  # incoming and held
    finally:
        for k, v in held.items():
            spark.conf.set(k, v)
