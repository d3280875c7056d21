import collections

import public_tokenizers
import tiktoken

import corpus_pipeline
from quillmart.llm import byte_bpe, common, queries, secrets, toxicity
from tests.llm import brute, data

SF = "/root/testdata/sf0.001"


def test_registered():
    import __spark_entry__ as entry
    assert set(queries.QUERIES) | {"pipeline"} <= set(entry.queries())
    assert [int(q[2:].split("_")[0]) for q in queries.QUERIES] == list(range(1, 14))


def test_pipeline_equals_its_stages_one_by_one(spark):
    documents = common.table(spark, SF, "documents")
    columns = documents.columns
    rows = [(r["doc_id"], r["text"], r["lang"], r["source"]) for r in documents.orderBy("doc_id").collect()]
    # toxicity: the model's scores decide
    model = toxicity.ToxicityModel(spark, documents, common.table(spark, SF, "labels"))
    bad = {r["doc_id"] for r in model.score(documents, ["doc_id"]).collect() if r["score"] >= toxicity.THRESHOLD}
    rows = [r for r in rows if r[0] not in bad]
    # one document of each component
    rows = [r for r, (d, n, c) in zip(rows, brute.jaccard(rows)) if n == 0 or d == c]
    # no benchmark item word for word (the data holds whole passages only)
    items = [" ".join(data.words(r["text"].lower())) for r in common.table(spark, SF, "benchmark").collect()]
    texts = {r[0]: " " + " ".join(data.words(r[1].lower())) + " " for r in rows}
    rows = [r for r in rows if not any(f" {i} " in texts[r[0]] for i in items)]
    # secrets: all values are masked but those of three owners and a tenth of all, none with more than half
    owners, seen = len({r[3] for r in rows}), {}
    for d, t, _, owner in rows:
        for *_, value in secrets.find_secrets(t.encode()):
            seen.setdefault(value, set()).add((owner, d))
    live = set()
    for v, uses in seen.items():
        of = collections.Counter(o for o, _ in uses)
        if len(of) < max(3, 0.1 * owners) or max(of.values()) > 0.5 * len(uses):
            live.add(v)
    ranks = byte_bpe.read_ranks(public_tokenizers.path(queries.MULTI_RANKS))
    true = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = {}
    for d, t, *_ in rows:
        raw, out, at = t.encode(), [], 0
        for start, _, stop, value in secrets.find_secrets(raw):
            if value in live:
                if start >= at:
                    out += [raw[at:start], b"[secret]"]
                at = max(at, stop)
        want[d] = true.encode_ordinary((b"".join(out) + raw[at:]).decode())
    docs = documents
    for name, apply in corpus_pipeline.STAGES:
        docs = common.stage(spark, apply(spark, docs, SF), "test-stage")
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == columns
    got = {r["doc_id"]: list(r["ids"]) for r in docs.collect()}
    assert got.keys() == want.keys() and got == want
    assert {r["doc_id"]: r["n_tokens"] for r in corpus_pipeline.run(spark, SF).collect()} == {d: len(i) for d, i in want.items()}


def test_stages_take_odd_rows_and_extra_columns(spark, tmp_path):
    rows = data.edge_rows(600)
    docs = data.documents(spark, rows).selectExpr("*", "1 AS row", "'x' AS found", "doc_id AS label", "text AS ids")
    sf = data.write_tables(
        spark, tmp_path, labels=spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int"),
        benchmark=spark.createDataFrame([(1, "none of these words is there at all")], "item_id long, text string"))
    for kept in (docs, docs.limit(0)):
        now = kept
        for name, apply in corpus_pipeline.STAGES:
            out = common.stage(spark, apply(spark, now, sf), "odd")
            if name != corpus_pipeline.STAGES[-1][0]:
                assert out.columns == docs.columns
            now = out
        assert now.count() == (kept.count() - 1 if kept is docs else 0)  # the repeated row goes
