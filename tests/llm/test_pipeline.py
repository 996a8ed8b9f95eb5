from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from postlake.llm import queries
from tests.llm.helpers import caption
from tests.llm.test_simhash import brute_fingerprint
from tests.llm.test_substrings import brute

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id string, caption string, kept boolean, score double, doc string, n_words int, n_removed int, kept_caption string, cut_id long, mixed_id long, rejected_id long"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, len(t or ""), "x", "y", True, 2.0, "d", 1, 1, "k", i, i, i) for i, t, s in rows], SCHEMA)


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    home = str(tmp_path_factory.mktemp("tables"))
    rows = [(k, caption(k, 120) + (" moronic scumbag" if k % 5 == 0 else ""), f"s{k % 3}") for k in range(300)]
    rows += [(1000 + k, rows[k][1] + " end", "s1") for k in range(1, 5)] + [(2000, None, None), (2001, "", "s0"), (2002, rows[7][1], "s2")]
    docs(spark, rows).write.parquet(f"{home}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i % 5 == 0)) for i, _, _ in rows if i < 300], "doc_id long, quality int, toxic int").write.parquet(f"{home}/labels.parquet")
    return home


def table(df):
    return {r["doc_id"]: r.asDict() for r in df.collect()}


def test_each_stage_acts_on_all_it_gets(spark, sf_dir, tmp_path):
    given = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = table(given)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, given, sf_dir)
        if name != "sentencepiece":
            assert out.columns == given.columns and out.dtypes == given.dtypes
        out.write.parquet(f"{tmp_path}/{name}")
        out = spark.read.parquet(f"{tmp_path}/{name}")
        after = table(out)
        assert out.count() == len(after)
        if name == "toxicity":
            gone = set(before) - set(after)
            assert gone <= {i for i in before if i % 5 == 0 and i < 300} and len(gone) > 55
            assert all(after[i] == before[i] for i in after)
        elif name == "simhash_near_dedup":
            prints = {i: brute_fingerprint(r["text"]) for i, r in before.items()}
            for i in set(before) - set(after):
                assert any(j < i and (prints[i] ^ prints[j]).bit_count() <= 4 for j in before)
            kept = sorted(after)
            assert not any((prints[a] ^ prints[b]).bit_count() <= 4 for a in kept for b in kept if a < b)
        elif name == "substring_dedup":
            expected = {i: (n, gone, left) for i, n, gone, left in brute([(i, r["text"]) for i, r in before.items()], 20)}
            for i, (n, gone, left) in expected.items():
                assert (i not in after) == (0 < gone == n)
                if i in after:
                    assert after[i]["text"] == (left if gone else before[i]["text"])
                    assert after[i]["n_chars"] == len(after[i]["text"] or "") or after[i]["text"] is None
        elif name == "mixing":
            for i, row in after.items():
                own, taken = Counter((before[i]["text"] or "").split()), Counter(row["text"].split())
                assert all(taken[w] <= 3 * own[w] for w in taken) and row["n_chars"] == len(row["text"])
                assert row["source"] == before[i]["source"] and row["score"] == 2.0
        else:
            assert {i: r["text"] for i, r in after.items()} == {i: r["text"] for i, r in before.items()}
            assert all(r["n_pieces"] == len(r["pieces"]) > 0 for r in after.values())
        given, before = out, after


def test_run_gives_the_last_stage(spark, sf_dir):
    out = corpus_pipeline.run(spark, sf_dir)
    assert out.columns == ["doc_id", "n_pieces", "pieces", "text"] and out.count() > 150


def test_stages_take_odd_tables(spark, sf_dir):
    odd = docs(spark, [(None, None, None), (None, "a b", "s"), (1, "a b", "s"), (1, "a b", "s"), (2, "", "s"), (3, caption(1, 20_000), None)])
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, odd, sf_dir).count() > 0, name
        assert stage(spark, odd.filter(F.lit(False)), sf_dir).count() == 0, name


def near(k):
    """A text and one whose fingerprint is near but not equal."""
    base = caption(k, 400)
    found = next(t for t in (f"{base} {w}" for w in caption(9, 200).split()) if 0 < (brute_fingerprint(t) ^ brute_fingerprint(base)).bit_count() <= 4)
    return base, found


def test_rows_that_share_an_id_are_judged_apart(spark, sf_dir):
    (first, copy), (other, close) = near(70), near(71)
    rows = [
        (1, first, "s"), (5, copy, "s"), (5, caption(72, 90), "s"), (7, other, "s"), (7, caption(73, 90), "t"), (8, close, "s"),
        (None, caption(74, 90), "s"), (None, caption(75, 90), "t"),
    ]
    out = corpus_pipeline.keep_one_of_near_copies(spark, docs(spark, rows), sf_dir)
    found = [(r["doc_id"], r["text"], r["source"]) for r in out.collect()]
    assert sorted(found, key=str) == sorted([r for k, r in enumerate(rows) if k not in (1, 5)], key=str)


def test_the_mix_keeps_the_columns_of_each_row(spark, sf_dir):
    rows = [(i, caption(80 + k, 256), s) for k, (i, s) in enumerate([(None, "a"), (None, "b"), (None, None), (1, "a"), (1, "b"), (1, None), (2, "b")])]
    given = docs(spark, rows).withColumn("lang", F.concat(F.lit("of "), F.substring("text", 1, 20)))
    out = corpus_pipeline.mix_sources(spark, given, sf_dir).collect()
    assert len(out) == len({r["lang"] for r in out}) > 4
    for r in out:
        (i, text, source), = [row for row in rows if r["lang"] == f"of {row[1][:20]}"]
        assert (r["doc_id"], r["source"]) == (i, source) and r["n_chars"] == len(r["text"])
        assert set(r["text"].split()) <= set(text.split())


def test_stages_take_tables_with_maps(spark, sf_dir):
    maps = {
        "tags": "map('a', 1, 'b', cast(null as int))", "none": "cast(null as map<string,int>)",
        "deep": "array(named_struct('k.x', map(1, map('z', doc_id)), 'y', 2), null)", "empty": "cast(map() as map<string,string>)",
    }
    rows = [(1, caption(90, 300), "a"), (2, caption(91, 300), "b"), (3, caption(92, 300), None), (None, caption(93, 300), "b"), (5, None, "b")]
    given = docs(spark, rows).selectExpr("*", *[f"{sql} AS {name}" for name, sql in maps.items()])
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, given, sf_dir)
        assert out.dtypes == given.dtypes, name
        found = {r["doc_id"]: r for r in out.collect()}
        assert len(found) >= 4, name
        for i, r in found.items():
            assert (r["tags"], r["none"], r["empty"]) == ({"a": 1, "b": None}, None, {})
            assert r["deep"][0]["k.x"] == {1: {"z": i}} and r["deep"][0]["y"] == 2 and r["deep"][1] is None
    assert corpus_pipeline.encode(spark, given, sf_dir).count() == len(rows)


def test_workers_get_small_batches(spark, sf_dir):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": [batch.num_rows]})

    given, key = docs(spark, [(1, caption(1, 60), "s")]), "spark.sql.execution.arrow.maxRecordsPerBatch"
    for name, stage in corpus_pipeline.STAGES:
        spark.conf.unset(key)
        stage(spark, given, sf_dir)
        seen = spark.range(0, 3500, 1, 1).mapInArrow(sizes, "n long").collect()
        assert sum(r["n"] for r in seen) == 3500 and max(r["n"] for r in seen) <= 1000, name
    spark.conf.unset(key)


def test_every_operator_is_registered():
    names = sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES)
    assert names == list(range(1, 14)) and len(corpus_pipeline.STAGES) == 5
