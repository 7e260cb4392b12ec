from collections import Counter, defaultdict

import corpus_pipeline
from pyspark.sql import functions as F

from graphmill.llm.substring import dedup_substrings
from graphmill.llm.toxicity import toxicity
from graphmill.llm.tokens import default_path, encoder

from .conftest import words
from .test_jaccard import brute as jaccard
from .test_substring import brute as substring

SF = "/root/testdata/sf0.001"


def test_every_stage_against_brute_force(spark, sf_docs):
    docs, columns = sf_docs, sf_docs.columns
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r for r in docs.collect()}
        out = stage(spark, docs, SF)
        rows = out.collect()
        if name != "packing":
            assert out.columns == columns
        if name == "toxicity":
            bad = {r.doc_id for r in toxicity(docs, spark.read.parquet(f"{SF}/labels.parquet")).where("predicted = 1").collect()}
            assert {r.doc_id for r in rows} == set(before) - bad and bad
        elif name == "n-gram Jaccard join":
            component, _ = jaccard([(i, r.text) for i, r in before.items()], 5, 80)
            assert sorted(r.doc_id for r in rows) == sorted(i for i, c in component.items() if c == i)
        elif name == "substring dedup":
            order = sorted(before)
            whole = dict(zip(order, substring([(i, before[i].text) for i in order]), strict=True))
            cleaned = {r.doc_id: r.text for r in dedup_substrings(spark, docs, anywhere=True).collect()}
            assert {r.doc_id: r.text for r in rows} == cleaned and all(r.n_chars == len(r.text) for r in rows)
            # repeats inside sentences go besides whole sentences
            assert all(not Counter(words(r.text)) - Counter(words(whole[r.doc_id])) for r in rows)
        elif name == "mixing":
            for r in rows:
                assert not Counter(words(r.text)) - Counter(words(before[r.doc_id].text)) and r.n_chars == len(r.text)
            total, got = (sum(len(words(r.text)) for r in x) for x in (before.values(), rows))
            assert abs(got - 1.5 * total) < 64 * len({r.source for r in before.values()}) + 64
        else:
            e = encoder(default_path())
            ids = defaultdict(int)
            for r in rows:
                ids[r.doc_id] += r.length
            want = Counter()
            for r in docs.collect():
                want[r.doc_id] += len(e.encode([r.text or ""])[0]) // e.dtype.itemsize + 1
            assert ids == want
        docs = spark.createDataFrame(rows, out.schema)
    key = lambda r: (r.doc_id, r.start, r.length, r.sequence_id, r.offset, r.ids)
    assert sorted(map(key, corpus_pipeline.run(spark, SF).collect())) == sorted(map(key, rows))


INNER = ("rid", "ord", "at", "lists", "blank", "run", "first", "last", "sno", "start", "words", "size", "c0", "c1", "n_removed", "n_sentences", "_gone", "_source", "row", "ids", "a.b")


def test_without_rows_and_with_columns_named_like_inner_ones(spark, no_docs, odd_docs):
    for docs in (no_docs, odd_docs.where("doc_id < 7 or doc_id is null")):
        docs = docs.withColumns({c: F.lit(i) if i % 2 else F.array(F.lit(c)) for i, c in enumerate(INNER)})
        some, columns = not docs.isEmpty(), docs.columns
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SF)
            rows = out.collect()
            if name != "packing":
                assert out.columns == columns and out.schema.simpleString() == docs.schema.simpleString()
                for r in rows:
                    assert all(r[c] == (i if i % 2 else [c]) for i, c in enumerate(INNER))
            docs = spark.createDataFrame(rows, out.schema)
        assert docs.isEmpty() != some


def test_rows_that_differ_in_another_column_only(spark):
    text = " ".join(f"w{i}" for i in range(200))
    docs = spark.createDataFrame([(1, text, "en", "a", len(text), x) for x in ("x", "y")] + [(2, "other words here", "en", "b", 16, "z")], "doc_id long, text string, lang string, source string, n_chars long, extra string")
    got = {(r.doc_id, r.extra) for r in corpus_pipeline.mixing(spark, docs, SF).collect()}
    assert {x for x in got if x[0] == 1} <= {(1, "x"), (1, "y")} and any(x[0] == 1 for x in got)
    cleaned = corpus_pipeline.substring_dedup(spark, docs, SF)
    assert sorted(r.extra for r in cleaned.collect()) == ["x", "y", "z"]
