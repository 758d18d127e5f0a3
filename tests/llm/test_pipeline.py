from __future__ import annotations

import corpus_pipeline
import numpy as np
from brute import leaks, mixed

from orderloom.llm import quality
from orderloom.llm.queries import END_ID, tokenizer_path

SF = "/root/testdata/sf0.001"


def rows(df):
    return sorted(map(tuple, df.select("doc_id", "text", "source").collect()))


def test_stages_against_brute_force(spark, tmp_path):
    """Each stage on what its predecessor kept, against its plain form."""
    from test_simhash import brute_fp, brute_groups
    from test_tokens import brute as brute_tokens
    from tokenizers import Tokenizer

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    items = [(b.item_id, b.text) for b in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_filter", "near_dedup", "decontamination", "mix", "token_output"]
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = rows(docs)
        out = stage(spark, docs, SF)
        if number < 4:
            assert out.columns == docs.columns
        out.write.parquet(f"{tmp_path}/{name}")
        out = spark.read.parquet(f"{tmp_path}/{name}")
        if name == "quality_filter":
            model = quality.train(docs, spark.read.parquet(f"{SF}/labels.parquet"))
            kept = {r.doc_id for r in quality.with_score(docs, model).filter("score >= 0.3").collect()}
            want = [r for r in before if r[0] in kept]
            assert 0 < len(want) < len(before)
        elif name == "near_dedup":
            named = brute_groups([(i, brute_fp(t)) for i, t, _ in before])
            want = [r for r, g in zip(before, sorted(named)) if g[0] == g[2]]
            assert len(want) < len(before)
        elif name == "decontamination":
            bad = {r[0] for r in leaks([(i, t) for i, t, _ in before], items) if r[5]}
            want = [r for r in before if r[0] not in bad]
            assert len(want) < len(before)
        elif name == "mix":
            want = sorted(r for r, n in zip(before, mixed(before)) for _ in range(n))
        else:
            made = Tokenizer.from_file(tokenizer_path())
            plain = lambda t: made.encode(t, add_special_tokens=False).ids
            assert sorted(map(tuple, out.collect())) == sorted(brute_tokens([r[:2] for r in before], plain))
            assert END_ID == 2 and np.sum([r.n_tokens for r in out.collect()]) > 0
            continue
        assert rows(out) == sorted(want), name
        docs = out


def test_run_gives_the_last_stage(spark):
    found = corpus_pipeline.run(spark, SF)
    assert found.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    starts = sorted((r.start, r.n_tokens) for r in found.collect())
    assert starts[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(starts, starts[1:]))
    assert corpus_pipeline.ORACLE_SQL is None


def odd_documents(spark):
    """Rows with nulls, empty texts, repeats and equal ids, under columns that the stages use themselves."""
    base = "the words of a page that says something " * 12
    rows = [
        (1, None, "en", "a", 0), (2, "", None, None, None), (None, base, "en", "a", 1), (None, None, None, None, None),
        (3, base, "en", "b", 5), (3, base, "en", "b", 5), (3, "other text under one id " * 9, "en", "b", 5),
        (4, base.upper(), "en", "c", 7), (5, " \n\t", "en", "c", 3), (6, "é漢字 😀 " * 40, "fr", "d", 9),
        (7, "long " * 60_000, "en", "a", 1), (-8, "below zero " * 30, "en", "a", 1),
    ]
    names = ["score", "_fp", "_row", "row", "id", "leak", "copy", "shuffle_key", "_key", "_parts", "_n", "_salt", "t"]
    ddl = "doc_id long, text string, lang string, source string, n_chars long, "
    made = [(*r, *(f"{n}-{k}" for n in names)) for k, r in enumerate(rows)]
    return spark.createDataFrame(made, ddl + ", ".join(f"{n} string" for n in names))


def test_stages_on_odd_rows(spark):
    docs = odd_documents(spark)
    before = {tuple(r) for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns, name
        after = [tuple(r) for r in out.collect()]
        assert {*after} <= before, name
        if name == "near_dedup":
            # Of the repeated rows and the near copies of one text, one stays.
            assert len(after) == len({*after}) and sum(r[0] == 3 for r in after) <= 2
            assert len([r for r in after if r[1] is None or not r[1].strip()]) == 1
        if name == "decontamination":
            assert {*after} == before
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert len(last) == docs.count() and min(r.n_tokens for r in last) == 1


def test_stages_on_no_rows(spark):
    docs = odd_documents(spark).limit(0)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).count() == 0, name
