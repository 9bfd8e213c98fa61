"""Cases in which an operator once did less than its whole job."""

import itertools
import random
import re

import numpy as np
import psutil
import pyarrow as pa
import pytest

import corpus_pipeline
from tidewater.llm import _arrow, decontam, jaccard_join, langid, packing, pii, queries, token_count

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string"


@pytest.mark.parametrize("batch, dense, copies", [(7, 16, 60), (50, 16, 60), (50, jaccard_join.DENSE, 600)])
def test_jaccard_join_of_a_neighbourhood_over_batch_borders(spark, batch, dense, copies):
    """Texts of 13 words, the last one their own: any two share 8 of 10 shingles and few neighbourhoods."""
    texts = [" ".join([f"t{k}" for k in range(12)] + [f"own{i}"]) for i in range(copies)]
    texts += [" ".join([f"t{k}" for k in range(6)] + [f"o{i}_{k}" for k in range(7)]) for i in range(20)]
    sets = [{tuple(w[i:i + 5]) for i in range(len(w) - 4)} for w in map(str.split, texts)]
    comp = list(range(len(texts)))
    for i, j in itertools.combinations(range(len(texts)), 2):
        if comp[i] != comp[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
            low, high = sorted((comp[i], comp[j]))
            comp = [low if c == high else c for c in comp]
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, batch)
    try:
        docs = spark.createDataFrame(list(enumerate(texts)), SCHEMA)
        got = jaccard_join.join_components(docs, dense=dense).orderBy("doc_id").collect()
    finally:
        spark.conf.set(name, before)
    assert [r.component_id for r in got] == comp


def test_pipeline_stages_drop_rows_and_not_ids(spark):
    rng = random.Random(1)
    text = lambda: [f"w{rng.randrange(10**6)}" for _ in range(40)]
    item = spark.read.parquet(f"{SF}/benchmark.parquet").where("size(split(text, ' ')) > 15").first().text
    near, other = text(), text()
    docs = [(3, near), (None, near[:-1] + ["x"]), (None, text()), (3, text()), (None, text()), (2, near + ["y"]),
            (None, other), (None, other + ["z"]), (8, near[1:]), (7, text()), (7, text() + item.split()), (None, item.split())]
    df = spark.createDataFrame([(i, " ".join(t)) for i, t in docs], SCHEMA)
    left = corpus_pipeline.near_duplicate_stage(spark, df, SF)
    want = [docs[k] for k in (2, 3, 4, 5, 9, 10, 11)]
    got = [(r.doc_id, r.text.split()) for r in left.collect()]
    assert left.columns == df.columns and len(got) == len(want) + 1
    assert all(d in got for d in want) and sum(t[:9] == other[:9] for _, t in got) == 1
    got = [(r.doc_id, r.text.split()) for r in corpus_pipeline.decontamination_stage(spark, df, SF).collect()]
    assert sorted(got, key=repr) == sorted(docs[:10], key=repr)


def test_languages_of_a_family_are_told_apart_pair_by_pair(spark):
    rng = random.Random(3)
    syllables = {"da": "af ej hv", "no": "av ei hv", "sv": "av ej ck", "fr": "eau oi que"}
    make = lambda lang, n: " ".join("".join(rng.choice(syllables[lang].split()) for _ in range(3)) for _ in range(n))
    train = {lang: [make(lang, 30) for _ in range(40)] for lang in syllables}
    table = lambda langs: spark.createDataFrame([(t, lang) for lang in langs for t in train[lang]], "text string, lang string")
    model = langid.fit(table(syllables))
    assert model.langs["germanic"] == ["da", "no", "sv"] and model.by_lang["germanic"].shape[1] == 3
    assert model.by_lang["romance"].shape[1] == 0
    for k, pair in enumerate(itertools.combinations(("da", "no", "sv"), 2)):  # no row of a third language has a say
        alone = langid.fit(table(pair)).by_lang["germanic"]
        assert np.allclose(model.by_lang["germanic"][:, [k]], alone, atol=1e-4)
    docs = spark.createDataFrame([(i, make(lang, 20)) for i, lang in enumerate([*syllables] * 9)], SCHEMA)
    got = langid.identify(docs, model).orderBy("doc_id").collect()
    assert [r.lang_pred for r in got] == [*syllables] * 9 and all(0 <= r.score <= 1 for r in got)


def test_votes_decide_and_margins_break_ties():
    best, score = langid.vote(np.array([[.1, .1, 9], [-.1, .2, -.4], [.4, -.2, .1]]), 3)  # 0:1, 0:2, 1:2
    assert best.tolist() == [0, 2, 0] and (score >= 0).all() and (score <= 1).all()
    assert langid.vote(np.zeros((2, 0)), 1)[1].tolist() == [1, 1]


def test_packing_goes_by_tokens_and_not_by_words(spark):
    texts = ["漢字" * 3000, "https://example.org/a?b=c," * 400, "aGVsbG8gd29ybGQ=" * 500, "a few words", None, ""] * 3
    docs = spark.createDataFrame([(i or None, t) for i, t in enumerate(texts)], SCHEMA)
    vocabulary = token_count.vocabulary()
    counts = [r.n_tokens for r in token_count.count_tokens(docs, vocabulary).collect()]
    assert min(counts[:3]) > 1000
    got = packing.pack_tokens(docs, vocabulary, budget=6000, buckets=4).collect()
    assert sorted(r.n_tokens for r in got) == sorted(counts)
    batches = {}
    for r in got:
        batches.setdefault((r.bucket, r.shard, r.batch), []).append(r)
    assert all(len(b) == 1 or sum(r.n_tokens for r in b) <= len(b) * b[0].bucket_len <= 6000 for b in batches.values())
    assert packing.pack_tokens(docs.limit(0), vocabulary).count() == 0


def test_queries_pack_by_tokens(spark):
    want = sorted(r.n_tokens for r in queries.op5_token_counts(spark, SF).collect())
    assert sorted(r.n_tokens for r in queries.op10_packing(spark, SF).collect()) == want
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert sorted(r.n_tokens for r in corpus_pipeline.packing_stage(spark, docs, SF).collect()) == want


def spans_of(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), SCHEMA)
    return {r.doc_id: r.spans.split(",") for r in pii.digest(pii.find_spans(docs)).collect()}


def test_terms_in_a_text_that_grows_in_lower_case(spark):
    texts = ["İstanbul: Zorblax and ZORBLAX, İzmir, zorblax", "İstanbul wrote from ann@x.org in İ"]
    texts += ["istanbul from ann@x.org here", "ISTANBUL from ann@x.org there", "call İSTANBUL"]
    texts += [f"istanbul {i} from ann@x.org" for i in range(8)]
    texts += [f"the zorblax wrote from bob@x.org in the year {i}" for i in range(5)]
    texts += [f"the weather in the year {i} was fine" for i in range(100)]
    got = spans_of(spark, texts)
    for k, term in ((0, "zorblax"), *((k, "istanbul") for k in range(13))):
        low = texts[k].replace("İ", "i").lower()
        assert {f"term:{m.start()}:{m.end()}" for m in re.finditer(term, low)} <= set(got[k]), k


@pytest.mark.parametrize("gap", [" " * 500, " -- " * 400, "\n" * 399 + " "])
def test_near_words_behind_a_long_gap(spark, gap):
    long = "x" * 450
    texts = [f"qorvex {k}{gap}bob@x.org{gap}{long}{k} zorblax a b c d e f g h i j k farther" for k in range(5)]
    texts += [f"the weather in the year {i} was fine" for i in range(40)]
    got = spans_of(spark, texts)
    for k in range(5):
        want = {f"term:{texts[k].index(t)}:{texts[k].index(t) + len(t)}" for t in ("qorvex", "zorblax")}
        assert want <= set(got[k]) and f"term:{texts[k].index('farther')}:{len(texts[k])}" not in got[k]


def test_decontamination_with_null_and_shared_item_ids(spark):
    one, two, three, four = ([f"{c}{k}" for k in range(n)] for c, n in (("a", 20), ("b", 18), ("c", 16), ("d", 5)))
    bench = spark.createDataFrame([(None, " ".join(one)), (4, " ".join(two)), (4, " ".join(three)), (None, " ".join(four))],
                                  "item_id bigint, text string")
    texts = [one, two + three, three, one + two, four, ["z"] * 30, three + four]
    docs = spark.createDataFrame([(i, " ".join(["x", *t, "y"])) for i, t in enumerate(texts)], SCHEMA)
    got = [tuple(r)[1:] for r in decontam.decontaminate(docs, bench).orderBy("doc_id").collect()]
    assert got == [(True, 1, None, 20), (True, 2, 4, 18), (True, 1, 4, 16), (True, 2, None, 20), (True, 1, None, 5),
                   (False, 0, None, 0), (True, 2, 4, 16)]


def test_url_rule_column_names_rules_of_the_contract_only(spark, tmp):
    urls = {"http://www.casino.net/en/1": (None, "casino", "block"), "http://cheap-pills.com/x": (None, "cheap-pills", "block"),
            "http://spam-farm.org/x": ("org/", None, "allow"), "http://casino.example.com/de/1": ("com/de/", None, "block"),
            "http://x.net/a/adserver/b": (None, "tracker-path", "block"), "http://x.net/": (None, None, "allow"),
            None: (None, None, "allow")}
    spark.createDataFrame([(i, u, None) for i, u in enumerate(urls)], "page_id bigint, url string, html string") \
        .write.parquet(f"{tmp}/pages.parquet")
    got = queries.op1_url_filters(spark, tmp).orderBy("page_id").collect()
    assert [(r.rule, r.pattern, r.verdict) for r in got] == list(urls.values())


def test_pipeline_hands_workers_small_batches(spark):
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    held = spark.conf.get(name)

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": [batch.num_rows]})

    docs = spark.range(30, numPartitions=1).selectExpr("id as doc_id", "repeat('ab ', 350000) as text", "'en' as lang",
                                                       "'x' as source", "1050000L as n_chars")
    try:
        for _, stage in corpus_pipeline.STAGES[::2]:
            spark.conf.unset(name)
            stage(spark, docs.limit(0), "")
            assert max(r.n for r in docs.mapInArrow(sizes, "n long").collect()) <= 5
    finally:
        spark.conf.set(name, held)


def test_workers_give_memory_back_and_scan_lists_all_pairs(spark):
    kept = [np.zeros(1000) for _ in range(40_000)]  # 300 MB in small pieces, the last one stays
    last = kept[-1]
    most = psutil.Process().memory_info().rss
    del kept
    list(_arrow.slices(pa.RecordBatch.from_pydict({"text": ["a"]}), "text"))
    assert len(last) == 1000 and most - psutil.Process().memory_info().rss > 200e6
    rows = spark.range(500).selectExpr("7L as bucket", "id as cls", "100 as n", "0 as pos", "0 as prio")
    found = jaccard_join.scan(rows, 80, 512).collect()
    assert len({(r.a, r.b) for r in found}) == len(found) == 500 * 499 // 2
