"""Personal data, SentencePiece encoding and the pipeline."""

import hashlib
import os
import random
import re
import zlib

import numpy as np


def test_base_spans_equal_plain_patterns():
    from ledgerline.llm.pii import KINDS, base_spans, luhn

    kinds = (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]")
    digits = lambda s: re.sub(r"[^0-9]", "", s)
    good = (lambda s: True, lambda s: all(int(p) <= 255 for p in s.split(".")), lambda s: 12 <= len(digits(s)) <= 19 and luhn(digits(s)), lambda s: 9 <= len(digits(s)) <= 15)
    rng = random.Random(4)
    texts = ["".join(rng.choice("ab.@-+ é19()0") for _ in range(40)) for _ in range(3000)] + ["4111 1111-1111 1111", "+1 (555) 123-4567", "1.2.3.4.5 300.1.1.1 0000255.1.1.1", ""]
    for t in texts:
        want = sorted((m.start(), k, m.end()) for k, p in enumerate(kinds) for m in re.finditer(p, t) if good[k](m.group()))
        assert [(s, k, e) for s, e, k in base_spans(t)] == want, t
    assert KINDS == ("email", "ip", "card", "phone")


def test_gradients_and_viterbi():
    from itertools import product

    from ledgerline.llm.pii import TAGS, Tagger, crf_gradients, viterbi

    rng = np.random.default_rng(0)
    m = Tagger(size=3, width=3, seed=1)
    m.p = {k: v.astype(np.float64) for k, v in m.p.items()}
    x, y = rng.integers(0, 9, (2, 5)), rng.integers(0, TAGS, (2, 5))
    _, grads = m.gradients(x, y)
    for name in ("wf", "wb", "bf", "out", "move"):
        at = tuple(rng.integers(0, s) for s in m.p[name].shape)
        values = []
        for step in (1e-4, -2e-4):
            m.p[name][at] += step
            values.append(m.gradients(x, y)[0])
        m.p[name][at] += 1e-4
        assert abs((values[0] - values[1]) / 2e-4 - grads[name][at]) < 1e-3
    e, move = rng.standard_normal((3, TAGS)) * 3, rng.standard_normal((TAGS, TAGS))
    legal = lambda c: (c[0] % 2 or not c[0]) and all(b % 2 or not b or a in (b, b - 1) for a, b in zip(c, c[1:]))
    score = lambda c: sum(e[t, k] for t, k in enumerate(c)) + sum(move[a, b] for a, b in zip(c, c[1:]))
    assert viterbi(e, move).tolist() == list(max((c for c in product(range(TAGS), repeat=3) if legal(c)), key=score))
    loss, _, _ = crf_gradients(e[:, None], move, np.zeros((3, 1), int))
    every = [score(c) for c in product(range(TAGS), repeat=3)]
    assert abs(loss - (np.log(np.sum(np.exp(every))) - score((0, 0, 0)))) < 1e-6


def test_pii_tagger_and_redaction(spark):
    from ledgerline.llm.pii import KINDS, base_spans, fit, pii_report, redact

    rng = random.Random(7)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 8)))
    makers = (lambda: f"{word()}.{rng.randint(1, 99)}@mail{rng.randint(0, 9)}.example.com", lambda: ".".join(str(rng.randint(0, 255)) for _ in range(4)), lambda: "".join(str(rng.randint(0, 9)) for _ in range(16)), lambda: f"+1 ({rng.randint(100, 999)}) 555-{rng.randint(1000, 9999)}")
    rows = []
    for i in range(300):
        words = [word() for _ in range(40)]
        words[rng.randrange(40)] = makers[i % 4]()
        rows.append((i, " ".join(words), 0))
    rows += [(400, None, 0), (401, "", 0), (402, "clean words only " * 2000, 0), (403, "x " * 20000 + "10.0.0.1 end", 0), (None, "a@b.cd", 0), (0, rows[0][1], 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, spans int")
    model = fit(docs)
    got = pii_report(docs, model).collect()
    assert len(got) == len(rows)
    texts = {i: t or "" for i, t, _ in rows}
    found = 0
    for r in got:
        base = base_spans(texts[r.doc_id])
        told = [f"{KINDS[k]}:{s}:{e}" for s, e, k in base]
        assert r.base_sha256 == hashlib.sha256(",".join(told).encode()).hexdigest()
        assert set(told) <= set(r.spans.split(",")) | {""} and (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(k == n for _, _, k in base) for n in range(4))
        found += bool(r.spans) and r.doc_id is not None and r.doc_id < 300
    assert found >= 290
    assert all(r.spans == "" for r in got if r.doc_id in (400, 401, 402))
    clean = redact(docs, model)
    assert clean.columns == docs.columns
    left = {r.doc_id: r.text for r in clean.collect()}
    assert left[403].endswith("<IP> end") and left[400] is None and "@" not in left[None]
    assert pii_report(docs.where("false"), None).count() == 0 and fit(docs.where("doc_id = 402")) is None


def test_pieces_equal_the_library(spark):
    import sentencepiece

    from ledgerline.llm.common import vocabulary
    from ledgerline.llm.pieces import encode, piece_report

    path = vocabulary("piece_bpe_32k.model")
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    rng = random.Random(2)
    alphabet = "ab the  é漢𝄞\n▁<0x41>s/Ⅷing tion.,  "
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40))) for _ in range(300)] + ["a" * 300, "ing" * 200, None, "", " ", "word " * 3000]
    docs = spark.createDataFrame([(i, t, 9) for i, t in enumerate(texts)] + [(0, texts[0], 1), (None, "x", 1)], "doc_id long, text string, ids int")
    ids = {r.doc_id: r.ids for r in encode(docs, path).collect()}
    for i, t in enumerate(texts):
        assert ids[i] == sp.encode(t or "")
    for r in piece_report(docs, path).collect():
        t = "x" if r.doc_id is None else texts[r.doc_id] or ""
        want = sp.encode(t)
        assert (r.n_pieces, r.ids_crc32) == (len(want), zlib.crc32(np.array(want, "<u4").tobytes())) and r.round_trip
        assert r.decoded_sha256 == hashlib.sha256(sp.decode(want).encode()).hexdigest()
    assert piece_report(docs.where("false"), path).count() == 0


def test_pipeline_stages_follow_their_operators(spark, tmp_path):
    import corpus_pipeline

    rng = random.Random(8)
    words = [a + b for a in ("ka", "lo", "mi", "ne", "su", "ra") for b in ("r", "ta", "ni", "x", "lo")]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    passage, base = text(60), text(200)
    rows = [(i, text(80), "en", "s", 1) for i in range(120)]
    rows += [(200 + i, " ".join(["vilest" if j % 9 == 0 else w for j, w in enumerate(text(60).split())]), "en", "s", 1) for i in range(40)]
    rows += [(300, base, "en", "s", 1), (301, base, "en", "s", 1), (302, base.replace(" ", "  ", 3) + " end", None, None, None), (303, text(30) + " " + passage, "en", "s", 1), (304, passage + " " + text(30), "en", "s", 1), (305, "mail me a.b@c.example.com now", "en", "s", 1), (306, None, "en", "s", 1), (307, "", "en", "s", 1)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(r[0], int(200 <= r[0] < 240)) for r in rows if r[0] < 240], "doc_id long, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    columns, kept = docs.columns, None
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, str(tmp_path))
        path = str(tmp_path / f"out-{name.replace(' ', '-')}")
        out.write.parquet(path)
        docs = spark.read.parquet(path)
        if name != "packing":
            assert docs.columns == columns
        kept = {r.doc_id: r for r in docs.collect()}
        if name == "toxicity":
            assert set(kept) == {r[0] for r in rows if not 200 <= r[0] < 240}
        if name == "near duplicates":
            assert set(kept) == {r[0] for r in rows if not 200 <= r[0] < 240} - {301, 302}
        if name == "repeated passages":
            assert passage in kept[303].text and passage not in kept[304].text and kept[300].text == base
        if name == "personal data":
            assert kept[305].text == "mail me <EMAIL> now"
    assert set(kept) == {r[0] for r in rows if not 200 <= r[0] < 240} - {301, 302}
    assert os.path.isdir(tmp_path)


def test_stages_take_hard_rows(spark, tmp_path):
    """Null ids and texts, repeated rows, further columns whose names operators use inside, no rows."""
    import corpus_pipeline

    rng = random.Random(12)
    text = lambda n: " ".join("".join(rng.choice("abcdefg") for _ in range(5)) for _ in range(n))
    extra = ["id", "token", "n", "a", "b", "grp", "score", "length", "bucket", "start", "spans", "count"]
    rows = [(i, text(40)) for i in range(30)] + [(None, text(30)), (None, None), (40, None), (41, ""), (42, text(3)), (42, text(3))]
    rows += [rows[0], rows[32]]
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in extra)
    spark.createDataFrame([(i, t, "en", None, 1, *extra) for i, t in rows], schema).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, 0), (2, None), (None, 1), (999, 1)], "doc_id long, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        none = stage(spark, docs.where("false"), str(tmp_path))
        assert none.count() == 0, name
        out = stage(spark, docs, str(tmp_path))
        out.write.parquet(str(tmp_path / name.replace(" ", "-")))
        docs = spark.read.parquet(str(tmp_path / name.replace(" ", "-")))
        if name == "packing":
            assert none.columns == docs.columns
        else:
            assert docs.columns == columns
            assert docs.count() == len(rows) - 2 * (name != "toxicity"), name  # of rows that repeat with an id one stays
            assert {r[0] for r in docs.select("doc_id").collect()} == {i for i, _ in rows}
    assert docs.where("doc_id is null").count() == 2 and docs.where("doc_id = 40").count() == 1


def test_near_duplicates_of_repeated_ids(spark, tmp_path):
    import corpus_pipeline

    rng = random.Random(9)
    text = lambda n: " ".join("".join(rng.choice("abcdefg") for _ in range(5)) for _ in range(n))
    a, b, c, d, e = (text(60) for _ in range(5))
    rows = [(1, a, "en"), (1, a, "en"), (2, b, "en"), (2, b, "en"), (2, b, "en")]  # equal rows
    rows += [(5, a, "en"), (5, c, "en"), (9, c, "de"), (3, d, "en"), (4, d + " end", "en"), (4, e, "en")]  # 5 and 4: one near copy, one clean
    rows += [(6, d, "en"), (6, d, "fr"), (7, e, "en"), (7, a, "en"), (8, "", "en"), (8, "", "en"), (None, a, "en"), (None, a, "en"), (10, None, "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    docs.write.parquet(str(tmp_path / "d"))
    docs = spark.read.parquet(str(tmp_path / "d"))
    got = corpus_pipeline.near_duplicates(spark, docs, str(tmp_path))
    assert got.columns == docs.columns
    want = [(1, a, "en"), (2, b, "en"), (5, c, "en"), (3, d, "en"), (4, e, "en"), (8, "", "en"), (None, a, "en"), (None, a, "en"), (10, None, "en")]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)


def test_pii_learns_from_all_ids_and_texts(spark):
    from ledgerline.llm.pii import learning_windows, sample_ids, shares

    docs = spark.range(20000).selectExpr("id AS doc_id", "concat('call ', id) AS text")
    ids = sorted(r.doc_id for r in sample_ids(docs, 100).collect())
    assert len(ids) == 100 and sum(i >= 10000 for i in ids) > 25  # the least id of each bucket is below 2,000
    assert shares(np.array([0, 3, 900, 500, 1]), 104).tolist() == [0, 3, 50, 50, 1] and shares(np.array([4, 5]), 9).tolist() == [4, 5]
    assert shares(np.array([7, 0, 7]), 1).tolist() == [1, 0, 1]
    texts = ["12 345 " * 21000, "write to jo.doe@mail.example.com", "server 10.20.30.40 is down"]
    codes, tags = learning_windows(texts, np.random.default_rng(0), 6000)
    assert len(codes) <= 6000 and {1, 3} <= {int(t) for w in tags for t in w}
