"""The training-data operators against brute force on small tables with nulls, empty and long texts, ties, repeated
rows and clashing column names; the given tables against DuckDB."""

import hashlib
import itertools
import random
import re
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidewater.llm import (bitpack, decontam, exact_dedup, jaccard_join, langid, packing, pii, quality, queries,
                           token_count, url_filter)
from tidewater.llm._arrow import slices

SF = "/root/testdata/sf0.001"
#: An id column, the text, and columns whose names the operators use inside.
SCHEMA = "doc_id bigint, text string, id bigint, norm string, hash string, n bigint, cls string, lang_pred string"
LONG = "lorem ipsum dolor " * 3000


def table(spark, texts, schema=SCHEMA):
    return spark.createDataFrame([(i, t, 7, "x", "y", 0, "z", "q") for i, t in enumerate(texts)], schema)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


TEXTS = [None, "", " \t\n", "a b", "ab", " a\nb ", "A b", LONG, LONG.strip(), "été Ünïcode 漢字", "x" * 50_000, "1 2 3"]


def test_url_rules(spark):
    rules = [url_filter.prefix_rule("org", "/", "allow"), url_filter.prefix_rule("example.org", "/en/1", "block"),
             url_filter.pattern_rule("spam", r"\A(?:[^/]*\.)?spam\.", ("spam",)),
             url_filter.pattern_rule("loose", r"/x{3}", ())]
    urls = {"http://a.EXAMPLE.org/en/17?q": ("a.example.org", "/en/17", "example.org/en/1", "block"),
            "http://example.org": ("example.org", "", None, "allow"), "https://org/": ("org", "/", "org/", "allow"),
            "http://notexample.org/en/1": ("notexample.org", "/en/1", "org/", "allow"), None: ("", "", None, "allow"),
            "no scheme": ("", "", None, "allow"), "": ("", "", None, "allow"),
            "http://b.spam.com/?a=://c/d": ("b.spam.com", "/", "spam", "block"),
            "http://a?x=://b/c": ("a", "", None, "allow"), "http://z.net/xxx#": ("z.net", "/xxx", "loose", "block")}
    pages = spark.createDataFrame([(i, u, "q") for i, u in enumerate(urls)], "page_id int, url string, host string")
    for block in (1, 3, 100):
        got = url_filter.filter_urls(pages, rules, block_rules=block).drop("n_candidates").orderBy("page_id").collect()
        assert [tuple(r)[1:] for r in got] == list(urls.values())
    assert url_filter.filter_urls(pages.limit(0), rules).count() == 0
    assert {r.verdict for r in url_filter.filter_urls(pages, []).collect()} == {"allow"}


def test_rules_are_filed_under_their_rarest_token():
    rules = [url_filter.pattern_rule("a", "x", ("com", "rare")), url_filter.pattern_rule("b", "x", ("com",))]
    assert url_filter.rule_index(rules, {"com": 9, "rare": 1}) == ({"rare": [0], "com": [1]}, [])


def test_masks_find_every_window_with_two_substitutions():
    for a, b in itertools.combinations(range(decontam.WINDOW), 2):
        assert any(not {a, b} & {s + i for i in m} for m in decontam.MASKS
                   for s in range(decontam.WINDOW - decontam.SPAN + 1))


def test_decontamination(spark):
    rng = random.Random(1)
    words = [f"w{i}" for i in range(2000)]
    item = rng.sample(words, 30)
    short = ["alpha", "beta", "gamma"]
    mid = [f"m{i}" for i in range(10)]
    bench = spark.createDataFrame([(5, " ".join(item)), (6, " ".join(item).upper()), (7, " ".join(short)), (8, None),
                                   (9, ""), (10, " ".join(mid))], "item_id bigint, text string")
    noise = lambda: rng.sample(words, 40)
    window = item[8:21]
    two, three = list(window), list(window)
    two[3] = two[9] = "zz"
    for i in (2, 6, 10):
        three[i] = "zz"
    texts = [noise() + item + noise(), noise() + two + noise(), three, window[:10], short, short[:2], mid, mid[:9]]
    docs = table(spark, [" ".join(t) for t in texts] + [None, "", LONG, "Alpha, BETA -- gamma!"])
    got = {r.doc_id: (r.contaminated, r.item_id, r.n_matched) for r in decontam.decontaminate(docs, bench).collect()}
    clean = (False, None, 0)
    assert got == {0: (True, 5, 30), 1: (True, 5, 11), 2: clean, 3: clean, 4: (True, 7, 3), 5: clean, 6: (True, 10, 10),
                   7: clean, 8: clean, 9: clean, 10: clean, 11: (True, 7, 3)}
    assert decontam.decontaminate(docs.limit(0), bench).count() == 0
    assert not any(r.contaminated for r in decontam.decontaminate(docs, bench.limit(0)).collect())
    assert decontam.decontaminate(docs.union(docs), bench).where("contaminated").count() == 10


PLAIN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def passes(kind, value):
    digits = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(x) <= 255 for x in value.split("."))
    if kind == "card":
        total = sum(d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(map(int, reversed(digits))))
        return 16 <= len(digits) <= 19 and total % 10 == 0
    return kind != "phone" or 8 <= len(digits) <= 15


def test_pii_base_spans(spark):
    rng = random.Random(2)
    texts = ["é 1.2.3.4.5.6.7.8 漢 a@b.c_d@e.f", "4785380592391139 4465758382889437 4465758382889437", "+1 (771) 555-1655",
             "0001.2.3.256 1.2.3.0255", "9" * 2_000, "a" * 2_000, ("1" * 20 + ".") * 100, None, "", "a@b.c" * 90,
             "+1" + " " * 2_000] + ["".join(rng.choice("aZ09.@+- ()%é\n") for _ in range(300)) for _ in range(60)]
    found = pii.find_spans(table(spark, texts))
    got = {r.doc_id: r for r in pii.digest(found).collect()}
    for i, text in enumerate(texts):
        spans = [[f"{k}:{m.start()}:{m.end()}" for m in re.finditer(p, text or "") if passes(k, m[0])]
                 for k, p in PLAIN.items()]
        assert [got[i][f"n_{k}"] for k in PLAIN] == [len(s) for s in spans], i
        listed = ",".join(s for one in spans for s in one)
        assert got[i].base_sha256 == hashlib.sha256(listed.encode()).hexdigest() and got[i].spans.startswith(listed)
    clean = {r.id: r.clean for r in pii.sanitise(found).collect()}
    assert clean[2] == "<PHONE>" and clean[8] == "" and clean[7] == ""
    assert pii.digest(pii.find_spans(table(spark, texts).limit(0))).count() == 0


def test_terms_that_reveal_an_entity(spark):
    texts = [f"the zorblax wrote from bob@x.org in the year {i}" for i in range(5)]
    texts += [f"the weather in the year {i} was fine" for i in range(40)] + ["call the zorblax"]
    found = pii.find_spans(table(spark, texts))
    got = {r.doc_id: r.spans for r in pii.digest(found).collect()}
    at = texts[0].index("zorblax")
    assert f"term:{at}:{at + 7}" in got[0] and got[45] == "term:9:16" and got[10] == ""
    assert {r.id: r.clean for r in pii.sanitise(found, generalise=False).collect()}[45] == "call the "


def test_language_id(spark):
    rng = random.Random(3)
    syllables = {"en": "the ing ed er on at", "de": "sch ung ein keit heit lich", "fr": "eau oi que eux ment ai",
                 "es": "ción ado mente os ar ez", "xx": "zz yy vv ww"}
    make = lambda lang, n: " ".join("".join(rng.choice(syllables[lang].split()) for _ in range(3)) for _ in range(n))
    train = spark.createDataFrame([(make(lang, 40), lang) for lang in syllables for _ in range(60)] + [(None, "en"), ("a", None)],
                                  "text string, lang string")
    model = langid.fit(train)
    texts = [make(lang, n) for lang in syllables for n in (20, 400)] + [None, "", "123 !?", LONG]
    want = [lang for lang in syllables for _ in (20, 400)] + ["und"] * 3
    docs = table(spark, texts)
    got = langid.identify(docs, model).orderBy("doc_id").collect()
    assert [r.lang_pred for r in got][:-1] == want and all(0 <= r.score <= 1 for r in got) and got[10].score == 0
    kept = langid.annotate(docs, model)
    assert kept.columns.count("lang_pred") == 1 and rows(kept.select("doc_id", "text")) == rows(docs.select("doc_id", "text"))
    assert {r.lang_pred for r in langid.identify(docs, langid.fit(train.limit(0))).collect()} == {"und"}
    assert langid.identify(docs.limit(0), model).count() == 0


def test_language_id_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    got = queries.op4_language_id(spark, "/root/testdata/sf0.01").join(docs, "doc_id").where("held_out")
    assert got.select(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] > 0.95


def greedy(word, vocabulary):
    n = at = 0
    while at < len(word):
        end = next((e for e in range(min(len(word), at + 8), at, -1) if word[at:e] in vocabulary), None)
        if end is None:
            return 1
        at, n = end, n + 1
    return n


def test_token_counts(spark):
    rng = random.Random(4)
    vocabulary = {b" ", *[bytes([c]) for c in b"abc"], *["".join(rng.choice("abc ") for _ in range(rng.randint(2, 6))).encode() for _ in range(60)]}
    texts = [None, "", "  ", "d", "abd"] + [" ".join("".join(rng.choice("abc") for _ in range(rng.randint(1, 30))) for _ in range(20)) for _ in range(30)]
    texts += ["abc" * 20_000, "a\x0bb\tc"]
    got = {r.doc_id: (r.n_words, r.n_tokens) for r in token_count.count_tokens(table(spark, texts), sorted(vocabulary)).collect()}
    for i, text in enumerate(texts):
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        assert got[i] == (len(words), sum(greedy(b" " + w.encode(), vocabulary) for w in words)), i
    assert token_count.count_tokens(table(spark, texts).limit(0), sorted(vocabulary)).count() == 0


@pytest.mark.parametrize("hot", [1000, 2])
def test_exact_dedup(spark, hot):
    texts = TEXTS + ["ab"] * 9 + [None, "a  b"]
    docs = table(spark, texts).union(table(spark, ["repeated row"])).union(table(spark, ["repeated row"]))
    docs = docs.union(spark.createDataFrame([(None, "ab", 7, "x", "y", 0, "z", "q")], SCHEMA))
    groups = {}
    data = [(r.doc_id, r.text or "") for r in docs.collect()]
    for i, text in data:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", text), []).append((-len(text), i is None, i))
    want = sorted((i, min(groups[k])[2], len(groups[k]), hashlib.sha256(k.encode()).hexdigest()) for i, text in data if i is not None
                  for k in [re.sub(r"[\x20\x09-\x0D]", "", text)])
    got = exact_dedup.exact_dedup(docs, hot_rows=hot)
    assert sorted(tuple(r) for r in got.where("doc_id is not null").select("doc_id", "keep_id", "group_size", "text_sha256").collect()) == want
    assert got.where("kept").count() == len(groups)
    kept = exact_dedup.kept_rows(docs, hot_rows=hot)
    assert kept.columns == docs.columns and rows(kept.select("doc_id")) == rows(got.where("kept").select("doc_id"))
    assert exact_dedup.exact_dedup(docs.limit(0)).count() == 0 and exact_dedup.kept_rows(docs.limit(0)).count() == 0


@pytest.mark.parametrize("bits", [1, 3, 8, 13, 16, 17, 32])
def test_pack_round_trip(bits):
    ids = np.random.default_rng(bits).integers(0, 2 ** bits, 1001).astype(np.uint32)
    assert np.array_equal(bitpack.unpack(bitpack.pack(ids, bits), len(ids), bits), ids)


@pytest.mark.parametrize("bits", [3, 16, 17])
def test_random_access(tmp_path, bits):
    ids = np.random.default_rng(1).integers(0, 2 ** bits, 5000).astype(np.uint32)
    with open(tmp_path / "x.ids", "wb") as f:
        w = bitpack.Writer(f, bits, block=101)
        for at in range(0, 5000, 250):
            w.add([at, None], np.array([100, 150]), ids[at:at + 250])
        w.close()
    r = bitpack.Reader(str(tmp_path / "x.ids"))
    assert r.n_ids == 5000 and r.doc_ids[:2] == [0, None] and r.ends[-1] == 5000
    for a, b in ((0, 0), (0, 5000), (100, 102), (99, 303), (4999, 5000), (202, 303)):
        assert np.array_equal(r.ids(a, b), ids[a:b])


def test_token_ids(spark, tmp):
    from tokenizers import Tokenizer
    path = queries.tokenizer_file("byte_bpe_50k.json")
    t = Tokenizer.from_file(path)
    rng = random.Random(5)
    texts = TEXTS + ["don't  stop \n\n now ", "<|endoftext|> x", "a  b 　  c", "tab\t\tend\t", "a\x1c b"]
    texts += ["".join(rng.choice("ab'1 .\n\té 漢") for _ in range(200)) for _ in range(50)]
    docs = table(spark, texts)
    got = {r.doc_id: tuple(r)[1:] for r in bitpack.read_ids(bitpack.write_ids(docs, tmp + "/ids", path, 2), at_once=50).collect()}
    start = 0
    for i, text in enumerate(texts):
        ids = t.encode(text or "", add_special_tokens=False).ids + [2]
        assert got[i] == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())), i
        start += len(ids)
    assert bitpack.read_ids(bitpack.write_ids(docs.limit(0), tmp + "/none", path, 2)).count() == 0


def test_known_pieces_are_not_encoded_again():
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(queries.tokenizer_file("byte_bpe_50k.json"))
    texts = ["one two, three", " two, ", "", "four one two, " + "x" * 100, "two, four", "a\x1c b", " 漢字 two, été"]
    whole = [t.encode(x, add_special_tokens=False).ids for x in texts]
    for most in (0, 3, 100):  # the long piece is never kept
        encoder, seen = bitpack.Encoder(t, most), []
        plain = encoder.encode_new
        encoder.encode_new = lambda pieces: seen.append(len(pieces)) or plain(pieces)
        for _ in range(2):
            ids, n = bitpack.encode_all(encoder, pa.array(texts, pa.large_string()))
            assert [list(x) for x in np.split(ids, np.cumsum(n)[:-1])] == whole
        assert seen == [seen[0], seen[0] - min(most, seen[0] - 1)] and len(encoder.known) == min(most, seen[0] - 1)


def shingle_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i:i + 5]) for i in range(max(len(words) - 4, 1))} if words else set()


@pytest.mark.parametrize("dense", [512, 6])
def test_jaccard_join(spark, dense):
    rng = random.Random(6)
    words = [f"w{i}" for i in range(400)]
    base = [rng.choice(words) for _ in range(60)]
    texts = [None, "", " ", "a b", "A\tB", "a b c", LONG, LONG + "x", " ".join(base)] + [" ".join(base)] * 3
    for k in range(40):  # near and not so near copies, and a passage that unlike texts share
        copy = list(base)
        for i in rng.sample(range(60), rng.choice([1, 1, 2, 3])):
            copy[i] = f"e{k}{i}"
        texts.append(" ".join(copy))
    texts += [" ".join([rng.choice(words) for _ in range(rng.randint(20, 90))] + base[:30]) for _ in range(30)]
    sets = [shingle_set(t) for t in texts]
    comp = list(range(len(texts)))
    for i, j in itertools.combinations(range(len(texts)), 2):
        if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]) and comp[i] != comp[j]:
            low, high = sorted((comp[i], comp[j]))
            comp = [low if c == high else c for c in comp]
    docs = table(spark, texts)
    got = [tuple(r) for r in jaccard_join.join_components(docs, dense=dense).orderBy("doc_id").collect()]
    assert got == [(i, len(s), c) for i, (s, c) in enumerate(zip(sets, comp, strict=True))]
    assert jaccard_join.join_components(docs.limit(0)).count() == 0
    assert jaccard_join.join_components(docs.union(docs.limit(9))).count() == len(texts) + 9


def test_quality(spark):
    rng = random.Random(7)
    words = [f"word{i}" for i in range(300)]
    def make(grade):
        t = [rng.choice(words) for _ in range(40)]
        return " ".join(t + ["scum"] * (grade < 2) + ["###"] * (grade < 1))
    grades = [i % 3 for i in range(300)]
    docs = table(spark, [make(g) for g in grades] + [None, "", LONG])
    ratings = spark.createDataFrame([(i, g) for i, g in enumerate(grades)] + [(0, None), (1, 9), (None, 1), (999, 1)],
                                    "doc_id bigint, grade int")
    model = quality.fit(docs, ratings)
    assert list(model.thresholds) == sorted(model.thresholds)
    got = quality.grade(docs, model).orderBy("doc_id").collect()
    right = sum(round(r.expected_grade) == g for r, g in zip(got, grades, strict=False))
    assert right > 285 and all(0 <= r.tail_probability <= 1 for r in got) and len(got) == 303
    none = quality.grade(docs, quality.fit(docs, ratings.limit(0))).collect()
    assert all(r.keep and r.expected_grade is None for r in none)
    assert quality.grade(docs.limit(0), model).count() == 0


def test_quality_finds_toxic_documents(spark):
    got = queries.op9_quality(spark, "/root/testdata/sf0.01").join(
        spark.read.parquet("/root/testdata/sf0.01/labels.parquet"), "doc_id")
    kept = {(r.quality, r.toxic): r.k for r in got.groupBy("quality", "toxic").agg(F.avg(F.col("keep").cast("int")).alias("k")).collect()}
    assert kept[1, 0] > 0.97 and kept[1, 1] < 0.3 and kept[0, 0] < 0.3


def test_optimal_buckets():
    rng = random.Random(8)
    for _ in range(60):
        histogram = [(x, rng.randint(1, 9)) for x in rng.sample(range(40), rng.randint(1, 9))]
        lengths = sorted(x for x, _ in histogram)
        for k in (1, 2, 3, 20):
            cost = lambda bounds: sum(n * next(b for b in bounds if b >= x) for x, n in histogram)
            best = min(cost((*c, lengths[-1])) for m in range(min(k, len(lengths)))
                       for c in itertools.combinations(lengths[:-1], m))
            bounds = packing.optimal_buckets(histogram, k)
            assert len(bounds) <= k and cost(bounds) == best
    assert packing.optimal_buckets([], 3) == []


def test_packing(spark):
    docs = table(spark, TEXTS + ["w " * n for n in range(1, 200)])
    got = packing.pack(docs, budget=300, buckets=5, shard_rows=50).collect()
    assert sorted(r.doc_id for r in got) == list(range(len(TEXTS) + 199))
    batches = {}
    for r in got:
        assert r.n_tokens <= r.bucket_len
        batches.setdefault((r.bucket, r.shard, r.batch), []).append(r)
    for batch in batches.values():
        assert sorted(r.place for r in batch) == list(range(len(batch)))
        assert len(batch) == 1 or len(batch) * batch[0].bucket_len <= 300 or batch[0].bucket_len == 0
    short = {}
    for key, batch in batches.items():
        short.setdefault(key[:2], []).append(len(batch) < max(1, 300 // max(1, batch[0].bucket_len)))
    assert all(sum(x) <= 1 for x in short.values())
    assert packing.pack(docs.limit(0)).count() == 0


def test_slices_of_nulls_and_sizes():
    batch = pa.RecordBatch.from_pydict({"id": list(range(7)), "text": ["ab", None, "", "x" * 100, "y", None, "é"]})
    for most, n in ((1, 3), (10, 2), (1000, 100)):
        parts = list(slices(batch, "text", most, n))
        assert [i for p in parts for i in p.column(0).to_pylist()] == list(range(7))
        assert [t for p in parts for t in p.column(1).to_pylist()] == ["ab", "", "", "x" * 100, "y", "", "é"]


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_matches_oracle(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = queries.QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    want = con.execute(f"SELECT {', '.join(cols)} FROM ({queries.SQL[name]})").fetchall()
    assert sorted(map(repr, want)) == sorted(repr(tuple(r)) for r in df.select(*cols).collect())


def test_pipeline_against_brute_force(spark):
    import corpus_pipeline
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    data = {r.doc_id: r.text or "" for r in docs.collect()}
    left = {i: t for i, t in data.items() if any(c.isalpha() for c in t)}
    groups = {}
    for i, t in left.items():
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", t), []).append((-len(t), i))
    left = {min(g)[1]: data[min(g)[1]] for g in groups.values()}
    sets = {i: shingle_set(t) for i, t in left.items()}
    comp = {i: i for i in left}
    for i, j in itertools.combinations(sorted(left), 2):
        if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]) and comp[i] != comp[j]:
            low, high = sorted((comp[i], comp[j]))
            comp = {k: low if c == high else c for k, c in comp.items()}
    left = {i for i in left if comp[i] == i}
    bad = {r.doc_id for r in queries.op2_decontamination(spark, SF).where("contaminated").collect()}
    got = corpus_pipeline.run(spark, SF).collect()
    assert {r.doc_id for r in got} == left - bad and len(got) == len(left - bad)
    stages = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        stages = stage(spark, stages, SF)
        assert stages.columns == docs.columns and stages.count() == 0
