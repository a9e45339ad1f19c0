"""Quality ledger, URL verdicts and toxicity."""

import re

import pytest
from pyspark.sql import functions as F

from tests.compare import connect, difference, explained, spark_rows, sql_rows
from tidemark.llm import catalog, queries, url_filter
from tidemark.llm.quality import BASE, BIT, RULES, STRICT, Policy, ablation, apply_policies, quality_filter, quality_ledger
from tidemark.llm.toxicity import toxicity_scores, train_toxicity

FOLDER = "/root/testdata/sf0.001"
NATIVE = ("op2_link_propagation", "op5_pfair_mixing", "op8_histogram_shards", "op10_quality_rules")


@pytest.mark.parametrize("name", list(catalog.oracle_sql()))
def test_query_matches_sql(spark, name):
    rows = spark_rows(catalog.queries()[name](spark, FOLDER))
    assert difference(rows, sql_rows(connect(FOLDER), catalog.oracle_sql()[name])) is None


@pytest.mark.parametrize("name", NATIVE)
def test_native_plans_have_no_python(spark, monkeypatch, name):
    """The plan of the result, and of every table that is written or row that is read on the way to it."""
    plans = []

    def seen(owner, method, frame):
        run = getattr(owner, method)
        monkeypatch.setattr(owner, method, lambda self, *a, **b: plans.append(explained(frame(self))) or run(self, *a, **b))

    result = spark.range(1)
    seen(type(result.write), "parquet", lambda writer: writer._df)
    for method in ("collect", "first", "count", "isEmpty"):
        seen(type(result), method, lambda df: df)
    plans.append(explained(catalog.queries()[name](spark, FOLDER)))
    assert name not in ("op5_pfair_mixing", "op8_histogram_shards") or len(plans) > 2
    for plan in plans:
        assert not re.search("EvalPython|PythonUDF|InPandas|InArrow|CartesianProduct|NestedLoop", plan)


def measures(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
    covered = {k + j for k, w in enumerate(windows) if windows.count(w) > 1 for j in range(3)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered)


def test_measures_of_odd_texts(docs_of):
    texts = [None, "", " ", "a", "a b c a b c", "x y z\nx y z\n\nx y z", "a a a a a", "é|é # é", "q w e r q w e t w e r", "one\n \none\n", "A\x0bB\x1cC D"]
    ledger = quality_ledger(docs_of(list(enumerate(texts))).withColumn("n_words", F.lit("mine")))
    for r in ledger.collect():
        got = (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"])
        assert got == measures(texts[r["doc_id"]]), texts[r["doc_id"]]
        assert r["failed_bits"] & BIT["few_words"]


def test_policies_and_ablation_read_only_bits(docs_of):
    good = " ".join(f"word{k}" for k in range(60))
    docs = docs_of([(1, good), (2, "few words"), (3, good + " #" * 30), (4, "### few"), (5, good.upper())])
    ledger = quality_ledger(docs)
    applied = {r["doc_id"]: (r["kept_base_v1"], r["kept_strict_v1"]) for r in apply_policies(ledger, BASE, STRICT).collect()}
    assert applied == {1: (True, True), 2: (False, False), 3: (True, False), 4: (False, False), 5: (True, False)}
    two = Policy("two", 1, ("few_words", "symbols"))
    rows = {r["rule"]: (r["fails"], r["rejects_alone"], r["kept_without"]) for r in ablation(ledger, two).collect()}
    assert rows == {"few_words": (2, 1, 3), "symbols": (2, 1, 3)}
    assert len(RULES) == len(set(BIT.values()))


def test_filter_returns_the_columns_it_got(odd_docs, no_docs, docs_of):
    good = " ".join(f"word{k}" for k in range(60))
    clash = docs_of([(1, good), (2, "x")]).withColumnRenamed("lang", "n_words").withColumnRenamed("source", "failed_bits")
    kept = quality_filter(clash)
    assert kept.columns == clash.columns and [r["doc_id"] for r in kept.collect()] == [1]
    assert quality_filter(odd_docs).columns == odd_docs.columns
    assert quality_filter(no_docs).count() == 0


def page(host, *links, path="/x"):
    return f"http://{host}{path}", "".join(f'<a href="//{to}/">x</a>' for to in links)


def test_hosts_paths_and_rules(spark):
    urls = ["http://WWW.Example.com/en/1?q#f", "https://a.net/es/", "ftp://net/fr", "http://x.com", "nothing", None, "http://Example.com#a/en/", "http://notcom/", "http://É.Com/\ny"]
    pages = spark.createDataFrame([(k, u, None) for k, u in enumerate(urls)], "page_id long, url string, html string")
    rows = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in url_filter.judge_urls(pages, queries.URL_RULES).collect()}
    assert rows == {
        0: ("www.example.com", "/en/1", "www.example.com/en/", "allow"),
        1: ("a.net", "/es/", "net/es/", "block"),
        2: ("net", "/fr", None, "allow"),
        3: ("x.com", "", None, "allow"),
        4: ("", "", None, "allow"),
        5: ("", "", None, "allow"),
        6: ("example.com", "", None, "allow"),
        7: ("notcom", "/", None, "allow"),
        8: ("É.com", "/\ny", "com/", "allow"),
    }
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    assert url_filter.judge_urls(empty, queries.URL_RULES).count() == 0


def test_scores_match_power_iteration(spark):
    """Trust along links, distrust against them, on a small graph with a cycle and repeated links."""
    linked = [("good.org", "mid.org"), ("mid.org", "good.org", "far.org"), ("far.org", "mid.org"), ("farm.org", "bad.org", "bad.org"), ("bad.org",), ("mid.org", "far.org")]
    pages = spark.createDataFrame([(k, *page(*p)) for k, p in enumerate(linked)], "page_id long, url string, html string")
    rules = [("allow", "good.org/"), ("block", "bad.org/")]
    rows = url_filter.judge_urls(pages, rules).collect()
    hosts = sorted({h for p in linked for h in p})
    links = {}
    for start, *ends in linked:
        for end in set(ends):
            links[start, end] = links.get((start, end), 0) + 1

    def rank(edges, seed):
        score = dict.fromkeys(hosts, 0.0)
        for _ in range(200):
            new = {h: 0.15 * (h == seed) for h in hosts}
            for (a, b), n in edges.items():
                new[b] += 0.85 * score[a] * n / sum(m for (x, _), m in edges.items() if x == a)
            score = new
        return score

    trust, distrust = rank(links, "good.org"), rank({(b, a): n for (a, b), n in links.items()}, "bad.org")
    for r in rows:
        assert r["trust"] == pytest.approx(trust[r["host"]], rel=5e-3)
        assert r["distrust"] == pytest.approx(distrust[r["host"]], rel=5e-3)
    assert {r["host"]: r["verdict"] for r in rows} == {"good.org": "allow", "mid.org": "allow", "far.org": "allow", "farm.org": "block", "bad.org": "block"}


def test_toxic_texts_are_found_among_unlabelled_ones(spark):
    rows = queries.QUERIES["op4_positive_unlabelled"](spark, "/root/testdata/sf0.1")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    held = rows.filter("held_out").join(labels, "doc_id").groupBy("toxic", "predicted").count().collect()
    n = {(r["toxic"], r["predicted"]): r["count"] for r in held}
    assert n[1, 1] / (n[1, 1] + n[1, 0]) > 0.8 and n[1, 1] / (n[1, 1] + n.get((0, 1), 0)) > 0.85
    assert rows.count() == 10_000 and rows.filter("score < 0 OR score > 1 OR score IS NULL").count() == 0


def test_toxicity_of_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(4, 1), (5, 1), (5, 1), (7, 0), (None, 1), (8, None), (99, 1)], "doc_id long, toxic int")
    weights = train_toxicity(odd_docs, labels)
    clash = odd_docs.withColumnRenamed("lang", "score")
    scored = toxicity_scores(clash, weights)
    assert sorted(scored.columns) == sorted(clash.columns) and scored.count() == 10
    assert all(0 <= r["score"] <= 1 for r in scored.collect())
    assert train_toxicity(odd_docs, labels.filter("false")) == {} == train_toxicity(no_docs, labels.filter("toxic = 0"))
    assert {r["score"] for r in toxicity_scores(odd_docs, {}).collect()} == {0.0}
    assert toxicity_scores(no_docs, weights).count() == 0
