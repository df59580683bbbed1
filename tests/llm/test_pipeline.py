from __future__ import annotations

import corpus_pipeline
from brute import words
from pyspark.sql import functions as F

from millrace.llm.base import materialize
from millrace.llm.mixing import mix_sources
from millrace.llm.quality_rff import score_quality


def test_stages_take_effect(spark, sf_dir, docs, labels):
    cols, now = docs.columns, docs
    seen = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = materialize(stage(spark, now, sf_dir), "stage")
        assert out.columns == cols
        seen[name] = (now, out)
        now = out
    before, after = seen["quality classifier"]
    good = {r["doc_id"] for r in score_quality(before, labels).filter("predicted = 1").collect()}
    assert {r["doc_id"] for r in after.collect()} == good and after.count() < before.count()
    before, after = seen["n-gram Jaccard join"]
    sets = {r["doc_id"]: {tuple(w[k : k + 5]) for w in [words(r["text"])] for k in range(max(1, len(w) - 4))} for r in before.collect()}
    left = [r["doc_id"] for r in after.collect()]
    assert len(left) == len(set(left))
    for k, a in enumerate(left):
        assert all(len(sets[a] & sets[b]) * 100 < 80 * len(sets[a] | sets[b]) for b in left[:k])
    before, after = seen["suffix-array dedup"]
    assert after.count() == before.count()
    whole = [r["text"].encode() for r in after.collect()]
    assert sum(map(len, whole)) <= sum(len(r["text"].encode()) for r in before.collect())
    before, after = seen["mixing sources to target weights"]
    want = {r["doc_id"]: r["copies"] for r in mix_sources(before).collect()}
    got: dict = dict.fromkeys(want, 0)
    for r in after.collect():
        got[r["doc_id"]] += 1
    assert got == want


def test_run_and_odd_rows(spark, tmp_path, odd, empty, labels):
    for name, df in (("odd", odd), ("empty", empty)):
        base = str(tmp_path / name)
        df.select("doc_id", "text", "lang", "source", "n_chars").write.parquet(f"{base}/documents.parquet")
        labels.write.parquet(f"{base}/labels.parquet")
        out = corpus_pipeline.run(spark, base)
        assert {"doc_id", "start", "length", "sequence_id", "offset"} <= set(out.columns)
        assert out.count() >= 0


CLASHES = "predicted score held_out doc copies taken target size source_size component_id class_id n_links n_shingles keys shingles kept n_removed n_spans chunk cell rep id root links start length offset sequence_id doc_tokens text_crc nth node open base p g n x y label_id hash".split()


def test_no_column_name_clashes(spark, sf_dir, docs):
    """Every stage keeps columns that are named like those of the operators, with their values."""
    now = docs.limit(60).select("*", *[F.lit(f"own {c}").alias(c) for c in CLASHES])
    for _, stage in corpus_pipeline.STAGES[:-1]:
        now = materialize(stage(spark, now, sf_dir), "stage")
        assert now.columns == [*docs.columns, *CLASHES]
        assert all(r[c] == f"own {c}" for r in now.collect() for c in CLASHES)
    assert corpus_pipeline.STAGES[-1][1](spark, now, sf_dir).count() >= now.count() > 0


def test_cut_characters_go_and_replacement_characters_stay(spark):
    """Only what a cut leaves of a character goes, and no two such rests make a new one."""
    common = "".join(f"{k:04d}" for k in range(60))
    # the passages of 2, 3 begin and end inside characters: \u00e9 c3 a9, \u0129 c4 a9, \u00e8 c3 a8
    rows = [(1, "a\ufffdb " + common + " c\ufffd"), (2, "x\ufffd \u0129" + common + "\u00e9 end"), (3, "y \u00e9" + common + "\u00e8 \ufffdend"), (4, "short \ufffd"), (5, None), (6, "p\ufffd!\u0269" + common + " t")]
    df = spark.createDataFrame([(i, t, None if t is None else len(t)) for i, t in rows], "doc_id long, text string, n_chars long")
    got = {r["doc_id"]: (r["text"], r["n_chars"]) for r in corpus_pipeline.repeated_strings(spark, df, "").collect()}
    want = {1: "a\ufffdb c\ufffd", 6: "p\ufffd!t", 2: "x\ufffd  end", 3: "y  \ufffdend", 4: "short \ufffd"}
    assert {i: got[i] for i in want} == {i: (t, len(t)) for i, t in want.items()}
    assert not got[5][0]


def test_mixture_tells_rows_of_one_id_apart(spark):
    """Null and shared ids: every text is taken as often as the mix says of it, not of its id."""
    rows = [(None if k % 3 else 7, " ".join(f"w{k}x{j}" for j in range(5 + k)), "ab"[k % 2]) for k in range(40)] + [(None, None, "a"), (None, "", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    want = sorted((r["size"], r["source"], r["copies"]) for r in mix_sources(df).filter("copies > 0").collect())
    got = corpus_pipeline.mixture(spark, df, "").collect()
    count: dict = {}
    for r in got:
        count[len(words(r["text"])), r["source"]] = count.get((len(words(r["text"])), r["source"]), 0) + 1
    assert sorted((*k, n) for k, n in count.items()) == want
