"""Fill-in-the-middle, phrases and repeated passages against brute force on small tables with nulls, empty and long
texts, ties, repeated rows and clashing column names."""

import hashlib
import random
import re
from collections import Counter

import numpy as np

from tidewater.llm import fill_middle, phrases, suffix_dedup

#: An id column, the text, and columns whose names the operators use inside.
SCHEMA = "doc_id bigint, text string, lang string, id bigint, n bigint, h1 string, form string, txt string, row bigint"
LONG = "lorem ipsum dolor " * 3000


def table(spark, rows):
    return spark.createDataFrame([(i, t, lang, 7, 0, "x", "y", "z", 3) for i, t, lang in rows], SCHEMA)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_fill_middle(spark):
    texts = ["", None, "a", " ", "abc def", "é漢字 𝔘x$1 \\1 .*", "has <P> inside", "<<S", "a\nb\r\n\0c", "1 2 3 4 5" * 2000, "<",
             "P><M", "$3<" * 50] * 8 + ["x" * 300_000, LONG * 10]
    ids = [None if i % 7 == 0 else 5 if i % 7 == 1 else i for i in range(len(texts))]
    docs = table(spark, [(i, t, "en") for i, t in zip(ids, texts)])

    def brute(i, t):
        t = t or ""
        units = re.findall("[A-Za-z]+|[^A-Za-z]", t, re.S)
        h = hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest()
        h = [int(h[k:k + 8], 16) for k in (0, 8, 16, 24)]
        x, y = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
        pre, mid, suf = "".join(units[:x]), "".join(units[x:y]), "".join(units[y:])
        if not t or any(m in t for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
            return i, len(units), "plain", None, None, sha(t), sha(t)
        spm = h[3] % 100 < 20
        out = f"<S>{suf}<P>{pre}<M>{mid}" if spm else f"<P>{pre}<S>{suf}<M>{mid}"
        return i, len(units), "spm" if spm else "psm", len(pre), len(mid), sha(out), sha(t)

    want = sorted((brute(i, t) for i, t in zip(ids, texts)), key=repr)
    assert rows(fill_middle.digest(fill_middle.fill_middle(docs))) == want
    assert {w[2] for w in want} == {"plain", "psm", "spm"}
    assert fill_middle.fill_middle(docs.limit(0)).count() == 0
    named = docs.withColumnRenamed("doc_id", "key").withColumnRenamed("text", "body").drop("id")
    assert rows(fill_middle.digest(fill_middle.fill_middle(named, "key", "body"))) == want
    alone = fill_middle.fill_middle(docs, plain_percent=0, spm_percent=100)
    assert {r.form for r in alone.where("output is not null and prefix_chars is not null").collect()} == {"spm"}


def brute_phrases(docs, most, threshold, top):
    """Contract in plain Python over (lang, text)."""
    f, total = Counter(), Counter()
    for lang, text in docs:
        lang = lang or "und"
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n-\r]", low):
            w = re.findall("[^ \t]+", piece)
            total[lang] += len(w)
            f.update((lang, tuple(w[i:i + k])) for k in range(1, most + 1) for i in range(len(w) - k + 1))
    often = {g: n for g, n in f.items() if n >= threshold}
    out = []
    for (lang, w), a in often.items():
        if len(w) < 2 or any(o == lang and len(v) > len(w) and m >= a and any(
                v[i:i + len(w)] == w for i in range(len(v))) for (o, v), m in often.items()):
            continue
        score, k = min((1000 * a * total[lang] // (f[lang, w[:k]] * f[lang, w[k:]]), k) for k in range(1, len(w)))
        out.append((lang, " ".join(w), a, f[lang, w[:k]], f[lang, w[k:]], total[lang], score))
    ranked = []
    for lang in total:
        own = sorted((r for r in out if r[0] == lang), key=lambda r: (-r[6], -r[2], r[1].encode()))[:top]
        ranked += [(lang, i + 1, *r[1:]) for i, r in enumerate(own)]
    return sorted(ranked, key=repr)


def phrase_docs():
    rng = random.Random(3)
    vocab = ["the", "of", "Été", "x" * 300, "a", "b", "漢", "\u00a0z", "Zed"]
    docs = []
    for i in range(160):
        words = rng.choices(vocab, [9, 8, 3, 1, 5, 5, 2, 1, 1], k=rng.choice([0, 1, 3, 20, 60]))
        text = "".join(w + rng.choice([" ", "  ", "\t", ". ", "\n", " ", " "]) for w in words)
        docs.append((rng.choice(["en", None, "fr"]), rng.choice([text, text, None if i % 9 == 0 else text])))
    return docs + [("en", "the of A the of a")] * 40 + [("de", ""), ("de", None), ("fr", "b " * 5000), ("it", "a b!")]


def test_phrases(spark):
    docs = phrase_docs()
    df = table(spark, [(i % 3, t, lang) for i, (lang, t) in enumerate(docs)]).repartition(5)
    want = brute_phrases(docs, 5, 8, 50)
    assert len(want) > 60 and {r[0] for r in want} >= {"en", "fr", "und"}
    assert rows(phrases.mine_phrases(df, threshold=8, top=50)) == want
    # a bitmap that lets nearly all through, and slices of a few texts: nothing changes
    assert rows(phrases.mine_phrases(df, threshold=8, top=50, n_bits=1 << 12)) == want
    assert rows(phrases.mine_phrases(df, most=3, threshold=30)) == brute_phrases(docs, 3, 30, 2000)
    assert phrases.mine_phrases(df.limit(0)).count() == 0
    assert phrases.mine_phrases(df, threshold=10**6).count() == 0


def test_summaries_keep_what_is_frequent():
    rng = np.random.default_rng(5)
    for slack in (1, 2, 4):
        items = np.minimum(rng.zipf(1.3, 200_000), 60_000).astype(np.uint64)
        truth = np.bincount(items.astype(int))
        held = phrases.Summary(100, slack, wait=500)
        for part in np.array_split(items, 97):
            v, c = np.unique(part, return_counts=True)
            held.add((v << np.uint64(32)) | c.astype(np.uint64))
        left = set(held.survivors().tolist())
        assert held.mass == len(items) and 0 < held.taken < 100
        assert set(np.flatnonzero(truth >= 100)) <= left and len(left) < len(np.flatnonzero(truth)) / 2
        assert len(held.held) <= slack * held.mass / 100 + 1


def test_packed_counts_come_back():
    values = np.array([0, 1, 7, 2**31, 2**32 - 1], np.uint32)
    counts = np.array([1, 2**31 + 5, 3, 1, 9])
    got = phrases._unpacked(phrases._packed(values, counts), 5)
    assert (got >> np.uint64(32)).tolist() == values.tolist()
    assert (got & np.uint64(0xFFFFFFFF)).tolist() == [1, 2**31, 3, 1, 9]


def brute_repeats(docs, length):
    """(id, bytes, removed, spans, hash of the rest) over (id, text) in the order of ids, nulls last, then as given."""
    seen, out = set(), []
    for i, text in sorted(docs, key=lambda d: (d[0] is None, d[0] or 0)):
        b = (text or "").encode()
        gone = bytearray(len(b))
        for k in range(len(b) - length + 1):
            if b[k:k + length] in seen:
                gone[k:k + length] = b"x" * length
            seen.add(b[k:k + length])
        spans = len(re.findall(b"x+", bytes(gone)))
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((i, len(b), gone.count(b"x"), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def passage_docs():
    rng = random.Random(8)

    def prose(n):
        return " ".join("".join(rng.choices("abcdeé漢", k=rng.randint(1, 7))) for _ in range(n))

    line, passage = prose(16), prose(60)
    docs = [None, "", "short", "a" * 99, "a" * 100, "a" * 101, "a" * 5000, "ab" * 700, prose(30) * 3, line, passage,
            passage[7:-9], "x" + passage, prose(2000), "é" * 120, "\0" * 250, (prose(9) + "\n") * 20, line * 2]
    for _ in range(60):
        own = prose(rng.choice([5, 20, 60]))
        docs += [own, rng.choice([own, own + " ", own[:len(own) // 2] + "Q" + own[len(own) // 2:], own + line + prose(9),
                                  prose(7) + passage + own])]
    docs += [docs[13]] * 4 + [docs[13][:5000] + "edit" + docs[13][5000:]]
    return docs


def test_removed_repeats(spark):
    texts = passage_docs()
    docs = list(enumerate(texts))
    df = table(spark, [(i, t, "en") for i, t in docs]).repartition(7)
    for length, sizes in ((100, {}), (100, {"hot_runs": 5, "bucket": 3000}), (31, {"n_bits": 1 << 12}),
                          (100, {"hot_runs": 2, "max_hot": 100_000})):
        got = rows(suffix_dedup.digest(suffix_dedup.remove_repeats(df, length=length, **sizes)))
        assert got == brute_repeats(docs, length)
    out = suffix_dedup.remove_repeats(df).collect()
    whole = {i: (t or "").encode() for i, t in docs}
    for r in out:  # the spans say what is gone
        b = whole[r.doc_id]
        assert bytes(r.kept) == b"".join(b[x:y] for x, y in zip([0] + [s.end for s in r.spans],
                                                                [s.begin for s in r.spans] + [len(b)]))
    assert suffix_dedup.remove_repeats(df.limit(0)).count() == 0


def test_repeats_of_rows_without_ids_of_their_own(spark):
    rng = random.Random(2)
    texts = [" ".join(rng.choices(["alpha", "beta", "gamma", "delta"], k=40)) for _ in range(30)]
    texts += texts[:20] + [texts[0]] * 30
    docs = [(None if i % 3 == 0 else 4 if i % 3 == 1 else i, t) for i, t in enumerate(texts)]
    got = rows(suffix_dedup.digest(suffix_dedup.remove_repeats(table(spark, [(i, t, "en") for i, t in docs]).coalesce(1))))
    assert got == brute_repeats(docs, 100)


def test_long_texts_are_hashed_in_pieces(spark, monkeypatch):
    rng = random.Random(5)
    own = "".join(rng.choices("abcdefgh ", k=9000))
    texts = [own + "x" + own[200:4000], "z" * 7000, own[:3000], "q" * 400 + own[5000:], "short"]
    docs = list(enumerate(texts))
    monkeypatch.setattr(suffix_dedup, "LONG", 700)
    monkeypatch.setattr(suffix_dedup, "SLICE", 1)  # a row at a time
    got = rows(suffix_dedup.digest(suffix_dedup.remove_repeats(table(spark, [(i, t, "en") for i, t in docs]))))
    assert got == brute_repeats(docs, 100)


def test_merged_transforms_equal_one_sort():
    rng = random.Random(4)
    for shard in (20, 90, 10**6):
        strings = [bytes(rng.choices(b"ab\0\xc3", k=rng.choice([0, 1, 5, 30, 60]))) for _ in range(40)]
        for depth in (1, 2, 7, 24):
            string, offset, block = suffix_dedup.repeats(strings, depth, shard)
            got, want = {}, {}
            for s, o, b in zip(string.tolist(), offset.tolist(), block.tolist()):
                got.setdefault(b, set()).add((s, o))
            for s, x in enumerate(strings):
                for o in range(len(x) - depth + 1):
                    want.setdefault(x[o:o + depth], set()).add((s, o))
            assert sorted(map(sorted, got.values())) == sorted(sorted(v) for v in want.values() if len(v) > 1)
            assert [want and strings[min(got[b])[0]] is not None for b in got] == [True] * len(got)
    # one transform of all strings is the merge of its shards to the end
    strings = [b"banana", b"", b"ananas", b"nab", b"banana"]
    bwt, places = suffix_dedup.transform(strings)
    text = b"\xff".join(strings) + b"\xff"
    suffix = [(text[p:].split(b"\xff")[0], text[:p].count(b"\xff")) for p in places.tolist()]
    assert suffix == sorted(suffix) and [0 if p == 0 or text[p - 1] == 255 else text[p - 1] + 1 for p in places.tolist()] == bwt.tolist()
