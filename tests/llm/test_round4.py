"""Unions of large groups as bitmaps."""

import random
from collections import Counter

import numpy as np


def test_unions_bound_overlaps_without_a_row_for_each_token(spark):
    """Of each query and group, the tokens that members have, or several of them, are counted in full,
    and little besides, from one row for each part."""
    from pyspark.sql import functions as F

    from ledgerline.llm import jaccard_join as J

    draw = random.Random(5)
    token = lambda: draw.getrandbits(63)
    core = {g: [token() for _ in range(300)] for g in (1, 2)}
    parts = {1: 1, 2: 3}
    members = [(g, parts[g], draw.sample(core[g], 250) + [token() for _ in range(20)]) for g in (1, 2) for _ in range(30)]
    rows = spark.createDataFrame(members, "grp long, parts int, tokens array<long>").repartition(5)
    marks = rows.mapInArrow(J._marks, "grp long, part int, once array<int>, again array<int>")
    unions = marks.repartition("grp", "part").sortWithinPartitions("grp", "part").mapInArrow(J._unions, "grp long, part int, held array<long>, several array<long>").collect()
    assert sorted((u["grp"], u["part"]) for u in unions) == [(1, 0), (2, 0), (2, 1), (2, 2)]
    bits = {(u["grp"], u["part"], kind): np.unpackbits(np.array(u[kind], np.int64).view(np.uint8), bitorder="little") for u in unions for kind in ("held", "several")}
    asks = [(a, 1, g, parts[g], draw.sample(core[g], 40 * a) + [token() for _ in range(100)]) for a in range(6) for g in (1, 2)]
    asks.append((9, 1, 1, 1, []))
    found = spark.createDataFrame(asks, "a long, own long, grp long, parts int, tokens array<long>").mapInArrow(J._places, "a long, own long, grp long, part int, places array<int>").collect()
    assert len(found) == sum(parts[a[2]] for a in asks if a[4])
    for kind, least in (("held", 1), ("several", 2)):
        counted = Counter()
        for r in found:
            counted[r["a"], r["grp"]] += int(bits[r["grp"], r["part"], kind][r["places"]].sum())
        for a, _, g, _, tokens in asks:
            having = Counter(t for h, _, own in members if h == g for t in own)
            true = sum(having[t] >= least for t in tokens)
            assert true <= counted[a, g] <= true + 15
    assert rows.where(F.size("tokens") < 0).mapInArrow(J._marks, "grp long, part int, once array<int>, again array<int>").count() == 0
