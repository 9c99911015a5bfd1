"""Quality by naive Bayes support vectors, whitening, and the Merkle manifest."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np

H = lambda *parts: hashlib.sha256("".join(parts).encode()).hexdigest()


def brute_manifest(rows):
    """{(doc_id, leaf): rows} of a plain recursive tree; rows are (doc_id, source, lang, n_chars, text)."""
    told = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    low = lambda t: None if t is None else "".join(c.lower() if c.isascii() else c for c in t)
    groups = defaultdict(list)
    for r in rows:
        leaf = H(*map(told, r))
        other = H(*map(told, (*r[:4], low(r[4])))) if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0 else leaf
        groups[r[1]].append((r[0] is not None, r[0] or 0, leaf, other))

    def climb(nodes):
        """(top, ways): for each node its (left, right) siblings level by level."""
        ways, at = [[] for _ in nodes], list(range(len(nodes)))
        while len(nodes) > 1:
            for i in range(len(ways)):
                first = at[i] // 16 * 16
                run = nodes[first : first + 16]
                ways[i].append(("".join(run[: at[i] - first]), "".join(run[at[i] - first + 1 :])))
            nodes = [H(*nodes[i : i + 16]) for i in range(0, len(nodes), 16)]
            at = [i // 16 for i in at]
        return nodes[0], ways

    sources = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    tops = {}
    for s in sources:
        groups[s].sort()
        tops[s] = climb([r[2] for r in groups[s]])
    root, over = climb([tops[s][0] for s in sources]) if sources else (None, [])
    out = []
    for s, above in zip(sources, over, strict=True):
        for (has, doc_id, leaf, other), way in zip(groups[s], tops[s][1], strict=True):
            h = other
            for left, right in way + above:
                h = H(left, h, right)
            out.append((doc_id if has else None, leaf, tops[s][0], root, H(*[a + b for a, b in way + above]), h, h == root))
    return out


KIND = "doc_id long, source string, lang string, n_chars long, text string"


def plain(rows):
    return sorted((tuple(r) for r in rows), key=repr)


def test_manifest_equals_plain_trees(spark):
    from ledgerline.llm.merkle import manifest

    rng = random.Random(1)
    rows = [(i, "hot", "en", 5, f"Text {i}") for i in range(300)] + [(1000 + i, f"s{i:02d}", None, None, None if i % 3 else "ABC é") for i in range(40)]
    rows += [(5, None, "de", 0, ""), (6, "", "de", -1, "Ä" * 3), (None, "hot", "en", 1, "NULL id"), (7, "hot", "en", 5, "Text 7"), (7, "hot", "en", 5, "Text 7"), (8, "é", "x", 1, "long " * 60_000), (9, "z", None, 3, "A:b")]
    rng.shuffle(rows)
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], f"{KIND}, idx int, key string").repartition(5)
    got = manifest(docs)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    got = got.collect()
    assert plain(got) == plain(brute_manifest(rows))
    assert any(not r.verified for r in got) and any(r.verified for r in got)


def test_manifest_of_hardly_any_rows(spark):
    from ledgerline.llm.merkle import manifest

    for rows in ([], [(1, None, None, None, None)], [(3, "a", "en", 1, "X"), (10, "b", "en", 1, "Y")], [(i, "a", "en", 1, "X") for i in range(17)]):
        got = manifest(spark.createDataFrame(rows, KIND)).collect()
        assert plain(got) == plain(brute_manifest(rows))


def test_manifest_equals_its_sql(spark, tmp_path):
    import duckdb
    from ledgerline.llm.oracle import merkle
    from ledgerline.llm.queries import op13_merkle

    rows = [(i, None if i % 7 == 0 else f"s{i % 3}", "en", i, f"Hello {i}") for i in range(150)]
    spark.createDataFrame(rows, KIND).write.parquet(str(tmp_path / "documents.parquet"))
    con = duckdb.connect()
    con.execute(f"create view documents as select * from read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    want = con.sql(merkle(3, 2))
    got = op13_merkle(spark, str(tmp_path))
    assert sorted(want.columns) == sorted(got.columns)
    assert plain(got.select(want.columns).collect()) == plain(want.fetchall()) and len(rows) == got.count()


def brute_whitening(vectors):
    x = [[int(np.floor(1024.0 * float(c))) + 100_000 for c in v] for v in vectors]
    n, sums = len(x), [sum(c) for c in zip(*x, strict=True)]
    exact = [sum((n * c - s) ** 2 for c, s in zip(r, sums, strict=True)) for r in x]
    centred = np.array([[(n * c - s) / n for c, s in zip(r, sums, strict=True)] for r in x])
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    return exact, values[::-1], centred @ vectors[:, ::-1], sum(exact) / n**3


def test_whitening_equals_plain_eigenvectors(spark):
    from ledgerline.llm.whitening import whitening_report

    rng = np.random.default_rng(3)
    body = (rng.standard_normal((400, 12)) * np.linspace(3, 0.2, 12) + 50).astype(np.float32).tolist()
    rows = [(i, v) for i, v in enumerate(body)] + [(None, body[0]), (3, body[3]), (500, [0.0] * 12)]
    bad = [(600, None), (601, []), (602, [1.0] * 11), (603, [None] + [1.0] * 11), (604, [float("nan")] + [1.0] * 11), (605, [float("inf")] + [1.0] * 11)]
    got = whitening_report(spark.createDataFrame([(*r, 1) for r in rows + bad], "vec_id long, embedding array<float>, n int").repartition(3)).collect()
    exact, values, projected, trace = brute_whitening([v for _, v in rows])
    assert len(got) == 8 * len(rows) and {r.component for r in got} == set(range(1, 9)) and {r.n for r in got} == {len(rows)}
    w = np.zeros((500, 8))
    for r in got:
        assert 0 <= r.identity_error < 1e-9 and abs(r.explained / (values[r.component - 1] / trace) - 1) < 1e-9
        if r.vec_id is not None and r.vec_id < 500:
            assert r.deviation == exact[r.vec_id] and r.deviation_exact == str(exact[r.vec_id])
            w[r.vec_id, r.component - 1] = r.whitened
    want = (projected / np.sqrt(values))[:400, :8]
    sign = np.sign((w[:400] * want).sum(axis=0))
    assert np.abs(w[:400] * sign - want).max() < 1e-7


def test_whitening_of_hardly_any_rank(spark):
    from ledgerline.llm.whitening import whitening_report

    kind = "vec_id long, embedding array<double>"
    assert whitening_report(spark.createDataFrame([], kind)).count() == 0
    assert whitening_report(spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], kind)).count() == 0
    got = whitening_report(spark.createDataFrame([(i, [float(i), 2.0 * i, 5.0, 0.0]) for i in range(5)], kind)).collect()
    assert {r.component for r in got} == {1} and len(got) == 5 and all(abs(r.explained - 1) < 1e-12 and r.identity_error < 1e-9 for r in got)
    far = whitening_report(spark.createDataFrame([(0, [1e15, 0.0]), (1, [-1e15, 1.0]), (2, [1e300, 0.0])], kind)).collect()
    exact, *_ = brute_whitening([[1e15, 0.0], [-1e15, 1.0]])
    assert {(r.vec_id, r.deviation, r.deviation_exact) for r in far} == {(i, None, str(e)) for i, e in enumerate(exact)}


def test_dual_descent_reaches_the_least_loss():
    from ledgerline.llm.quality import dual_descent

    rng = np.random.default_rng(5)
    x = rng.standard_normal((40, 3))
    signs = np.where(x[:, 0] + 0.7 * rng.standard_normal(40) > 0, 1.0, -1.0)
    costs = np.where(signs > 0, 0.5, 2.0)
    w, bias = dual_descent([(np.arange(3), r) for r in x], signs, costs, 3, rounds=5000, close=1e-9)
    loss = lambda w, b: (w @ w + b * b) / 2 + (costs * np.maximum(0, 1 - signs * (x @ w + b))).sum()
    here = loss(w, bias)
    for _ in range(2000):
        step = rng.standard_normal(4) * 10 ** rng.uniform(-4, 0)
        assert loss(w + step[:3], bias + step[3]) >= here - 1e-7


def test_bucket_sets_are_those_of_each_text_alone():
    from ledgerline.llm.bytescan import join_texts
    from ledgerline.llm.quality import bucket_sets

    texts = [b"", b"a", b"ab cd", "é word word word".encode(), b"x y " * 90_000, b"ab cd"]
    together = list(bucket_sets(*join_texts(texts)))
    for t, found in zip(texts, together, strict=True):
        alone = next(bucket_sets(*join_texts([t])))
        assert found.tolist() == alone.tolist() == sorted(set(alone.tolist()))
    assert len(together[0]) == 0 and together[2].tolist() == together[5].tolist()


def quality_rows(rng, n):
    words = ["ka", "lom", "minet", "suran", "rato", "nivel", "xara", "loti"]
    for i in range(n):
        text = [rng.choice(words) + rng.choice(words) for _ in range(rng.randint(8, 60))]
        good = rng.random() < 0.8
        if not good:
            text = [w.upper() + "!!" for w in text] if i % 2 else [w for w in text for _ in range(4)]
        yield i, " ".join(text), int(good)


def test_quality_is_learned_and_held_out(spark):
    from ledgerline.llm.quality import fit, quality_report

    rows = list(quality_rows(random.Random(9), 900))
    more = [(None, "ka lom", 1), (2000, None, 0), (2001, "", 0), (0, rows[0][1], 1), (2002, "minet suran " * 20_000, 1)]
    docs = spark.createDataFrame([(i, t, 1.5) for i, t, _ in rows + more], "doc_id long, text string, score double")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(None, 1), (5, None), (6, 7)], "doc_id long, quality int")
    got = quality_report(docs, labels).collect()
    assert len(got) == len(rows) + len(more)
    truth = {i: y for i, _, y in rows}
    held = [r for r in got if r.held_out and r.doc_id in truth]
    assert len(held) > 100 and all(r.held_out == (zlib.crc32(b"" if r.doc_id is None else str(r.doc_id).encode()) % 5 == 0) for r in got)
    assert sum(r.predicted == truth[r.doc_id] for r in held) >= 0.98 * len(held)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    assert len({r.score for r in got if r.doc_id in (2000, 2001)}) == 1 and len({r.score for r in got if r.doc_id == 0}) == 1
    one = labels.where("quality = 1")
    assert fit(docs, one) is None and {r.score for r in quality_report(docs, one).collect()} == {0.5}
    assert quality_report(docs.where("false"), labels).count() == 0


def test_quality_counts_every_learning_text(spark):
    """The ratios come from all labelled texts, also where the sample is smaller."""
    from ledgerline.llm import quality

    rows = list(quality_rows(random.Random(4), 300))
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, quality int")
    model = quality.fit(docs, labels, None, most=20)
    times = np.zeros((2, quality.BUCKETS), int)
    for _, t, y in rows:
        times[y, next(quality.bucket_sets(*quality.join_texts([t.encode()])))] += 1
    n = [sum(y == k for *_, y in rows) for k in (0, 1)]
    assert np.array_equal(model.ratio, quality.log_ratios(times[1], times[0], n[1], n[0]))
