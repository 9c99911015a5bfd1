"""Text operators against brute force on small fixtures with nulls, ties, copies and long texts."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, token int, id string"


def fixture(spark, more=()):
    rng = random.Random(5)
    words = [f"{a}{b}" for a in ("ka", "lo", "mi", "Né", "su") for b in ("r", "ta", "Ñi", "x")]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    base, passage = text(60), text(40)
    rows = [(1, base), (2, base), (3, base + " tail"), (4, None), (5, ""), (6, " \t "), (7, "one two"), (8, "one two"), (9, passage), (10, text(20) + " " + passage + text(20)), (11, text(3000) + passage), (12, base.upper())]
    rows += [(20 + i, " ".join([*base.split()[:i], "zz", *base.split()[i + 1 :]])) for i in range(0, 12, 3)]
    rows += [(None, base), (1, base), *more]
    return spark.createDataFrame([(i, t, 1, "x") for i, t in rows], SCHEMA)


def shingles(text, n=4):
    w = re.findall(rb"[^\x20\x09-\x0d]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} or ({tuple(w)} if w else set())


def linked(sets, percent=85):
    """The least id that each id of ``sets`` reaches, by comparing all pairs."""
    lead = {i: i for i in sets}
    find = lambda x: x if lead[x] == x else find(lead[x])
    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                lead[y] = x
    return {i: find(i) for i in sets}


def test_jaccard_components(spark):
    from ledgerline.llm.jaccard_join import jaccard_components

    docs = fixture(spark)
    rows = docs.select("doc_id", "text").collect()
    reached = linked({r.doc_id: shingles(r.text) for r in rows if r.doc_id is not None})
    got = [(r.doc_id, r.n_shingles, r.component_id) for r in jaccard_components(docs).collect()]
    want = [(r.doc_id, len(shingles(r.text)), None if r.doc_id is None else reached[r.doc_id]) for r in rows]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert reached[23] == 1 and reached[12] != 10
    assert jaccard_components(docs.where("false")).count() == 0


@pytest.mark.parametrize("small", [16, 2])
def test_jaccard_opens_groups(spark, monkeypatch, small):
    """Groups around a leader with members that don't link with it but with each other, by edits
    that several of them share; ``small`` decides which groups have their overlaps counted."""
    from ledgerline.llm import jaccard_join

    monkeypatch.setattr(jaccard_join, "SMALL", small)
    opened, differing = [], jaccard_join._differing
    monkeypatch.setattr(jaccard_join, "_differing", lambda *a: opened.append(differing(*a)) or opened[-1])
    rng = random.Random(11)
    words = [f"w{i}" for i in range(400)]
    rows = []
    for base in range(3):
        text = [rng.choice(words) for _ in range(80)]
        rows += [(len(rows) + k, " ".join(text)) for k in range(2)]
        cuts = [rng.randrange(80) for _ in range(6)]
        for _ in range(40):
            own = list(text)
            for at in sorted(rng.sample(cuts, rng.randint(1, 4)), reverse=True):
                del own[at]
            for _ in range(rng.randint(0, 3)):
                own[rng.randrange(len(own))] = rng.choice(words)
            rows.append((len(rows), " ".join(own)))
    rows += [(len(rows) + k, " ".join(rng.choice(words) for _ in range(60))) for k in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    reached = linked({i: shingles(t) for i, t in rows})
    got = {r.doc_id: r.component_id for r in jaccard_join.jaccard_components(docs).collect()}
    assert got == reached
    assert 10 < len(set(reached.values())) < len(rows) - 40
    assert opened and opened[0].count() > 0


def test_jaccard_where_most_of_a_group_are_apart_from_its_leader(spark):
    """A few near copies of one text, many of a changed one that most of its prefix stays in, some
    between, and a long text with its near copy."""
    from ledgerline.llm.jaccard_join import jaccard_components

    rng = random.Random(21)
    words = [f"w{i}" for i in range(500)]
    text = [rng.choice(words) for _ in range(120)]
    other = list(text)
    for at in range(5, 120, 17):
        other[at] = rng.choice(words)
    rows = []
    for body, copies in ((text, 6), (other, 70)):
        for _ in range(copies):
            own = list(body)
            for _ in range(rng.randint(0, 2)):
                own[rng.randrange(120)] = rng.choice(words)
            rows.append((len(rows), " ".join(own)))
    for mixed in range(12):
        own = [b if at < 10 * mixed else a for at, (a, b) in enumerate(zip(text, other, strict=True))]
        rows.append((len(rows), " ".join(own)))
    long = [rng.choice(words) for _ in range(60_000)]
    rows += [(500, " ".join(long)), (501, " ".join(long[:30_000] + ["new"] + long[30_001:])), (502, " ".join(long[:20_000]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.doc_id: r.component_id for r in jaccard_components(docs).collect()}
    assert got == linked({i: shingles(t) for i, t in rows}) and got[501] == 500 and got[502] == 502


def dedup(rows, length):
    seen, out = {}, {}
    for doc, text in sorted({(i, t) for i, t in rows if i is not None}, key=lambda x: x[0]):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for i in range(len(data) - length + 1):
            if data[i : i + length] in seen:
                gone[i : i + length] = b"\1" * length
            else:
                seen[data[i : i + length]] = 1
        kept = bytes(c for c, g in zip(data, gone, strict=True) if not g)
        out[doc] = (len(data), sum(gone), len(re.findall(rb"\x01+", bytes(gone))), hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize("hot", [2000, 1])
def test_suffix_dedup(spark, monkeypatch, hot):
    from ledgerline.llm import suffix_dedup

    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    rng = random.Random(8)
    shared = " ".join(rng.choice(["ka", "lomi", "nesu", "tar", "ix"]) for _ in range(30))
    many = [(100 + i, f"{rng.random()} {shared[rng.randrange(40) :]} {rng.random()}") for i in range(25)]
    docs = fixture(spark, [(30, "ab" * 300), (31, "x" * 250 + "ab" * 60), (32, "y" * 99), *many]).repartition(3)
    want = dedup([(r.doc_id, r.text) for r in docs.collect()], 100)
    for r in suffix_dedup.suffix_dedup_report(docs, 100).collect():
        if r.doc_id is None:
            assert r.n_removed == 0
        else:
            assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == want[r.doc_id], r
    cut = suffix_dedup.suffix_dedup(docs, 100)
    assert cut.columns == docs.columns and cut.count() == docs.count()
    assert suffix_dedup.suffix_dedup_report(docs.where("false"), 100).count() == 0


def test_suffix_array_orders_all_suffixes():
    import numpy as np

    from ledgerline.llm.suffix_dedup import repeated_windows, suffix_array

    rng = np.random.default_rng(2)
    for n in (0, 1, 2, 3, 4, 5, 6, 7, 30, 200):
        for k in (1, 2, 5):
            x = rng.integers(1, k + 1, n)
            assert suffix_array(x).tolist() == sorted(range(n), key=lambda i: x[i:].tolist())
    data = rng.integers(0, 2, 400).astype(np.uint8)
    label = repeated_windows(data, np.arange(391), 10)
    names = {}
    assert len({(names.setdefault(data[i : i + 10].tobytes(), len(names)), label[i]) for i in range(391)}) == len(names)


def test_packing_covers_every_id(spark):
    import zlib

    import numpy as np
    from tokenizers import Tokenizer

    from ledgerline.llm.common import vocabulary
    from ledgerline.llm.packing import pack

    path = vocabulary("byte_bpe_50k.json")
    docs = fixture(spark, [(40, "a<|endoftext|>b  \n\n c's ²"), (41, "word " * 5000), (42, "\u00a0 x\u2003\u2003y \n\u00a0z\n \n a\tb\x1c c"), (43, " lead and trail \n")])
    rows = pack(docs, path).collect()
    encode = Tokenizer.from_file(path)
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append(r)
    for doc in docs.collect():
        ids = encode.encode(doc.text or "", add_special_tokens=False).ids + [1]
        own = sorted({(r.start, r.length, r.ids_crc32) for r in by[doc.doc_id]})
        assert sum(n for _, n, _ in own) == len(ids) == by[doc.doc_id][0].doc_tokens
        for start, n, crc in own:
            assert zlib.crc32(np.array(ids[start : start + n], "<u4").tobytes()) == crc
    seqs = {}
    for r in rows:
        seqs.setdefault(r.sequence_id, []).append((r.offset, r.length))
    total = 0
    for parts in seqs.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= 2048
        total += at
    assert len(seqs) <= total / 2048 + 2
    assert pack(docs.where("false"), path).count() == 0


@pytest.mark.parametrize("seed", range(5))
def test_shortest_pack_first(seed):
    """Against one that places each length by itself into the pack with the most room."""
    from ledgerline.llm.packing import patterns

    rng = random.Random(seed)
    lengths = sorted((min(100, int(rng.expovariate(0.03)) + 1) for _ in range(400)), reverse=True)
    packs: list[list[int]] = []
    for length in lengths:
        shortest = min(packs, key=sum, default=None)
        if shortest is None or sum(shortest) + length > 100:
            packs.append([length])
        else:
            shortest.append(length)
    found = patterns({n: lengths.count(n) for n in set(lengths)}, 100)
    assert sorted(sum(p) for p, c in found for _ in range(c)) == sorted(map(sum, packs))
    assert sorted(x for p, c in found for _ in range(c) for x in p) == sorted(lengths)
    assert patterns({1500: 1, 1200: 1, 100: 1}) == [((1500,), 1), ((1200, 100), 1)]


def test_secret_scan(spark):
    from ledgerline.llm.secret_scan import BASE, MORE, scan_text, secret_report, trigram_query

    texts = ['Token = "' + "a1" * 20 + '" x', "api_key:abcdefg apikey='zzzzzzz' token=ab", "AKIA" + "Q" * 16 + " AKIASHORT", "ñ𝄞 password = hunter22 " * 30, "f" * 24 + "g" + "0" * 23, 'token=token"=abcdefgh', "ghp_" + "A" * 36, None, "", "-----BEGIN RSA PRIVATE KEY-----", "PASSWD:\n secret:    'qwertyu"]
    docs = spark.createDataFrame([(i, t, 3, "x") for i, t in enumerate(texts)] + [(0, texts[0], 1, "y"), (None, texts[1], 1, "z")], "doc_id long, text string, low int, trigram string")
    got = secret_report(docs).collect()
    assert len(got) == docs.count()
    source = {r.doc_id: r.text for r in docs.collect()}
    for r in got:
        text = source[r.doc_id] or ""
        base = scan_text(text, BASE)
        assert r.base_sha256 == hashlib.sha256(",".join(f"{k}:{s}:{e}" for s, e, k in base).encode()).hexdigest(), (r, base)
        assert r.spans == ",".join(f"{k}:{s}:{e}" for s, e, k in scan_text(text, BASE + MORE))
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(k == kind for _, _, k in base) for kind in ("assign", "access", "hex"))
    assert trigram_query(r"[0-9a-f]{24,}") == [] and trigram_query(r"AKIA[A-Z0-9]{16,}") == [frozenset([frozenset(["aki", "kia"])])]
    assert secret_report(docs.where("false")).count() == 0
    long = spark.createDataFrame([(1, "x" * 300_000 + " token = abcdefgh " + "pa\u017fsword=abcdefgh " + "y" * 300_000)], "doc_id long, text string")
    row = secret_report(long).first()
    assert row.n_assign == 1 and row.spans == "assign:300001:300017"


def test_language_id(spark):
    from ledgerline.llm.language_id import identify_languages

    import random

    rng = random.Random(1)
    stems = {"aa": ["taro", "miku", "sani"], "bb": ["zelt", "grub", "schn"]}
    rows = [(i, " ".join(rng.choice(stems[l]) + rng.choice("xy") for _ in range(30)), l) for i in range(80) for l in [("aa", "bb")[i % 2]]]
    rows += [(100, None, "aa"), (101, "12 !", "bb"), (102, "", None), (103, "taroxmiku saniy", None), (None, "zelty", "bb"), (103, "taroxmiku saniy", None)]
    docs = spark.createDataFrame([(*r, 0.5) for r in rows], "doc_id long, text string, lang string, score double")
    got = identify_languages(docs).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    assert [by[i].lang_pred for i in (100, 101, 102, 103)] == ["und", "und", "und", "aa"]
    assert all(by[i].lang_pred == ("aa", "bb")[i % 2] for i in range(80)) and all(0 <= r.score <= 1 for r in got)
    assert identify_languages(docs.where("false")).count() == 0


def test_language_against_exact_sets():
    """Filters against plain sets of n-grams: the same languages, nearly the same shares."""
    import numpy as np

    from ledgerline.llm import language_id as L

    rng = random.Random(4)
    stems = {"aa": ["taro", "miku", "sani", "kelo"], "bb": ["zelt", "grub", "schn", "kelo"], "cc": ["été", "noël", "çava", "kelo"]}
    text = lambda l, n: " ".join(rng.choice(stems[l]) + rng.choice("xyz") for _ in range(n))
    known = [(text(l, 40), l) for l in stems for _ in range(30)]
    filters = L.train([t for t, _ in known], [l for _, l in known])
    cut = lambda t, n: [t.lower().encode()[i : i + n] for i in range(len(t.encode()) - n + 1)]
    sets = {}
    for l in stems:
        own = [t for t, k in known if k == l]
        for n in L.SIZES:
            times = {}
            for t in own:
                for g in set(cut(t, n)):
                    times[g] = times.get(g, 0) + 1
            sets[l, n] = {g for g, c in times.items() if c >= max(2, 0.02 * len(own))}
    texts = [text(l, n) for l in stems for n in (1, 3, 30, 4000)] + ["kelo kelo", "q"]
    got = L.score_bytes(filters, *L.join_texts([t.encode() for t in texts]))
    for t, row in zip(texts, got, strict=True):
        total = max(1, sum(len(cut(t, n)) for n in L.SIZES))
        want = np.array([sum(g in sets[l, n] for n in L.SIZES for g in cut(t, n)) / total for l in filters.languages])
        assert np.allclose(row, want, atol=0.01), (t[:20], row, want)
        assert len(t) < 10 or row.argmax() == want.argmax()
    assert not L.has_letter("² ½ Ⅷ 12_") and not L.has_letter(None) and L.has_letter("²é")


def test_language_sample_meets_all_ids(spark):
    from ledgerline.llm.language_id import sample

    docs = spark.range(20000).selectExpr("id AS doc_id", "string(id) AS text", "'aa' AS lang")
    ids = [int(r.text) for r in sample(docs, 100, 2, 4).collect()]
    assert len(ids) == 100 and sum(i >= 10000 for i in ids) > 25


def test_more_than_64_languages():
    from ledgerline.llm.language_id import predict, train

    rng = random.Random(3)
    names = [f"l{i:03}" for i in range(130)]
    stems = {n: ["".join(rng.choice("abcdefghijklmnop") for _ in range(7)) for _ in range(6)] for n in names}
    text = lambda n: " ".join(rng.choice(stems[n]) for _ in range(20))
    filters = train([text(n) for n in names for _ in range(4)], [n for n in names for _ in range(4)])
    assert predict(filters, [text(n) for n in names]) == names


def test_toxicity(spark):
    from ledgerline.llm.toxicity import drop_toxic, fit, marginals, score_texts, toxicity_report

    import numpy as np

    rng = random.Random(2)
    bad, good = ["vilest", "grossly"], ["calm", "blue", "stone", "river", "light"]
    rows, labels = [], []
    for i in range(240):
        words = [rng.choice(good) for _ in range(rng.randint(5, 40))]
        if i % 4 == 0:
            for _ in range(4):
                words[rng.randrange(len(words))] = rng.choice(bad)
        rows.append((i, " ".join(words), 1))
        labels.append((i, int(i % 4 == 0)))
    rows += [(900, None, 1), (901, "", 1), (None, "calm vilest", 1), (0, rows[0][1], 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    table = spark.createDataFrame([*labels, (1, None), (None, 1)], "doc_id long, toxic int")
    got = toxicity_report(docs, table).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    truth = dict(labels)
    assert all(r.predicted == truth[r.doc_id] for r in got if r.doc_id in truth)
    assert drop_toxic(docs, table).where("doc_id < 240").count() == 180
    field = fit(docs, table)
    scores, marks = score_texts(field, ["calm vilest river grossly stone vilest", None], spans=True)
    assert (5, 11) in marks[0] and marks[1] == []
    text = "İİ calm vilest grossly vilest"
    assert {text[s:e] for s, e in score_texts(field, [text], spans=True)[1][0]} == {"vilest", "grossly"}
    told = {r.doc_id: r.spans for r in got}
    assert told[901] == "" and any(told[i] for i in range(0, 240, 4))
    long = score_texts(field, ["calm " * 200_000, "calm vilest grossly vilest " + "blue " * 200_000])
    assert len(long) == 2 and all(0 <= x <= 1 for x in long)
    # marginals against enumeration of all taggings
    u, t = np.array([0.3, -1.0, 2.0, 0.1]), np.array([[0.0, -0.4], [0.2, 0.7]])
    total, each = 0.0, np.zeros(4)
    for m in range(16):
        tags = [(m >> k) & 1 for k in range(4)]
        w = np.exp(sum(u[k] * tags[k] for k in range(4)) + sum(t[tags[k], tags[k + 1]] for k in range(3)))
        total += w
        each += w * np.array(tags)
    assert np.allclose(marginals(u, np.array([4]), t), each / total)
    assert toxicity_report(docs.where("false"), table.where("false")).count() == 0
