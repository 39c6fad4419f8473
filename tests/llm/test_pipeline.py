import pytest

import corpus_pipeline
from tessella.llm import common, queries, quality_rules, toxicity
from tests.llm.helpers import documents, none_of
from tests.llm.test_others import mixed_by_hand
from tests.llm.test_simhash import close, fingerprint, groups
from tests.oracle import SF, check

QUERIES, ORACLES = queries.queries(), queries.oracle_sql()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, name):
    check(spark, QUERIES[name], ORACLES[name])


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_without_sql_returns_a_row_for_each(spark, name):
    assert QUERIES[name](spark, SF).count() >= 50


def check_packed(packed, texts, ids):
    """Every copy of every document in pieces without a gap, and every sequence filled without one."""
    from collections import Counter

    from tessella.llm.tokens import encoder

    encode, owed, places = encoder(queries.tokenizer("word_bpe_49k.json")).ids, Counter(), {}
    for i in ids:
        blob = encode((texts[i] or "").encode()) + b"\1\0\0\0"
        owed.update((i, n, at // 4, min(16_384, len(blob) - at) // 4) for n, at in enumerate(range(0, len(blob), 16_384)))
    rows = packed.collect()
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"]) for r in rows) == owed
    for r in rows:
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for own in places.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 4096


def test_awkward_and_empty_tables(spark, tmp_path):
    """Nulls in every column, empty and long texts, repeated rows and ids, columns named like the operators', and no rows at all."""
    docs = documents(spark)
    labels = spark.createDataFrame([(i, i % 2, i % 3) for i in range(60)] + [(None, 1, 1), (3, None, None), (5, 0, 1)], "doc_id long, quality int, toxic int")
    for name, df, known in (("full", docs, labels), ("unlabelled", docs, none_of(labels)), ("empty", none_of(docs), labels), ("nothing", none_of(docs), none_of(labels))):
        folder = str(tmp_path / name)
        df.write.parquet(f"{folder}/documents.parquet")
        known.write.parquet(f"{folder}/labels.parquet")
        before = spark.read.parquet(f"{folder}/documents.parquet")
        for stage, function in corpus_pipeline.STAGES[:-1]:
            function(spark, before, folder).write.parquet(f"{folder}/{stage}")
            after = spark.read.parquet(f"{folder}/{stage}")
            assert after.columns == docs.columns and (after.subtract(before) if stage == "mix_sources" else after.exceptAll(before)).isEmpty()
            before = after
        found = corpus_pipeline.run(spark, folder)
        assert {"doc_id", "piece", "sequence_id", "offset"} <= set(found.columns) and found.isEmpty() == (df is not docs)


def test_stages_one_by_one(spark):
    """Each stage does to its input what its operator says of every row."""
    docs = queries.table(spark, SF, "documents")
    columns, labels = docs.columns, queries.table(spark, SF, "labels")
    before = docs
    for name, stage in corpus_pipeline.STAGES:
        path = common.new_path(spark, f"test-{name}")
        stage(spark, before, SF).write.parquet(path)
        after = spark.read.parquet(path)
        ids = sorted(r["doc_id"] for r in after.collect())
        own = {r["doc_id"]: r["text"] for r in before.select("doc_id", "text").collect()}
        if name == "toxicity":
            scored = toxicity.score(before, toxicity.fit(before, labels)).collect()
            assert ids == sorted(r["doc_id"] for r in scored if not r["predicted"])
        elif name == "quality_rules":
            assert ids == sorted(r["doc_id"] for r in quality_rules.judge(before).collect() if r["kept"])
        elif name == "simhash_dedup":
            fps = {i: fingerprint(t) for i, t in own.items()}
            label = groups(close(sorted(set(fps.values()))), sorted(set(fps.values())))
            lowest = {}
            for i, f in fps.items():
                lowest[label[f]] = min(lowest.get(label[f], i), i)
            assert ids == sorted(lowest.values())
        elif name == "mix_sources":
            rows = [(r["doc_id"], r["text"], r["source"]) for r in before.collect()]
            assert ids == sorted(i for i, _, _, copies in mixed_by_hand(rows) for _ in range(copies))
        else:
            check_packed(after, own, [r["doc_id"] for r in before.collect()])
        if name != "pack_sequences":
            assert after.columns == columns
        before = after
    assert {"doc_id", "sequence_id", "offset", "length"} <= set(before.columns) and len(corpus_pipeline.STAGES) == 5
    assert corpus_pipeline.run(spark, SF).count() == before.count()
