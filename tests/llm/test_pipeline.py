import hashlib
from collections import Counter

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from loadledger.llm.langid import fit, learnable
from loadledger.llm.mixing import mix

from test_decontam import brute as leaks
from test_langid import brute_predict
from test_similar import brute_groups


def brute(spark, docs, sf_dir):
    """Ids kept after each stage, from the stages' rules applied to rows in memory."""
    rows = {r.doc_id: r for r in docs.collect()}
    kept = []
    model = fit(learnable(docs))

    def near(text):
        lang, score = brute_predict(model, text)
        return lang != "und" and score >= model.limits[model.languages.index(lang)]

    rows = {i: r for i, r in rows.items() if near(r.text)}
    kept.append(set(rows))
    first = {}
    for i in sorted(rows):
        first.setdefault(" ".join((rows[i].text or "").split()) if (rows[i].text or "").split() else rows[i].text, i)
    rows = {i: rows[i] for i in first.values()}
    kept.append(set(rows))
    rows = {i: rows[i] for i, least in brute_groups([(i, r.text) for i, r in rows.items()]).items() if i == least}
    kept.append(set(rows))
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
    found = {i for i, _ in leaks([(i, r.text) for i, r in rows.items()], items)}
    rows = {i: r for i, r in rows.items() if i not in found}
    kept.append(set(rows))
    return kept, rows


def test_stages_agree_with_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    kept, last = brute(spark, docs, sf_dir)
    columns = docs.columns
    for (name, stage), want in zip(corpus_pipeline.STAGES, kept):
        docs = stage(spark, docs, sf_dir).cache()
        assert docs.columns == columns
        assert {r.doc_id for r in docs.select("doc_id").collect()} == want, name
    copies = {r.doc_id: r.copies for r in mix(docs).collect() if r.copies}
    result = corpus_pipeline.mixed(spark, docs, sf_dir)
    assert result.columns == [*columns, "copies"]
    assert {r.doc_id: r.copies for r in result.collect()} == copies
    run = {r.doc_id: r.copies for r in queries()["pipeline"](spark, sf_dir).collect()}
    assert run == copies and set(run) <= set(last)


def test_hard_rows(spark, tables):
    text = "the thing that was here and the other thing with them"
    rows = [(i, f"{text} number {'x' * i} of many more words {i} to tell them " + " ".join(f"of{i}the{k}" for k in range(20)),
             "en", f"s{i % 3}", 1) for i in range(40)]
    rows += [(100, None, "en", None, None), (101, "", None, "s1", 0), (None, text + " nobody", None, None, None),
             (102, rows[0][1], "en", "s1", 1), (102, rows[0][1], "en", "s1", 1), (103, text + " q" * 50_000, None, "s2", 1)]
    shape = "doc_id long, text string, lang string, source string, n_chars long"
    folder = tables(documents=(rows, shape), benchmark=([(1, None), (2, rows[5][1])], "item_id long, text string"))
    got = corpus_pipeline.run(spark, folder).collect()
    ids = {r.doc_id for r in got}
    assert not ids & {5, 100, 101, 102} and all(r.copies in (1, 2, 3) for r in got)


def test_empty_table(spark, tables):
    shape = "doc_id long, text string, lang string, source string, n_chars long"
    folder = tables(documents=([], shape), benchmark=([], "item_id long, text string"))
    assert corpus_pipeline.run(spark, folder).collect() == []


def test_registration():
    assert queries()["pipeline"] is corpus_pipeline.run
    assert "pipeline" not in oracle_sql() and corpus_pipeline.ORACLE_SQL is None
    assert sorted(int(n[2:].split("_")[0]) for n in queries() if n.startswith("op")) == list(range(1, 14))


def test_the_mix_takes_the_rows_it_drew(spark):
    shape = "doc_id long, text string, source string, lang string"
    rows = [(None if i % 3 else i, f"the words of {'more ' * (i % 40)} and {i}", f"s{i % 2}", "en") for i in range(300)]
    rows += [(7, "four words and equal", "s1", lang) for lang in ("de", "en", "en", None)] * 5 + [(None, None, None, None)] * 4
    docs = spark.createDataFrame(rows, shape).repartition(3).cache()
    drawn, taken = mix(docs).collect(), corpus_pipeline.mixed(spark, docs, "").collect()

    def words(text):
        return len((text or "").split())

    want, got = Counter(), Counter()
    for r in drawn:
        want[r.doc_id, r.source, r.text_sha256, r.copies] += bool(r.copies)
    for r in taken:
        got[r.doc_id, r.source, hashlib.sha256((r.text or "").encode()).hexdigest(), r.copies] += 1
    assert +want == got
    assert sum(r.taken for r in drawn) == sum(r.copies * words(r.text) for r in taken)
