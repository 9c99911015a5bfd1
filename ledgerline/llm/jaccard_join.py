"""Exact n-gram Jaccard self-join by a token-group matrix.

Every distinct shingle set is one row (a *class*). Classes are put into groups of similar sets,
each around a leader; the matrix holds, for each token and group, how many members have the token,
with the best position and the sizes they allow. A query's tokens are looked up in the matrix and
summed for each group: first its prefix tokens, then, for large groups, all of its tokens in the
union of all the members' tokens. A union is a bitmap in parts, so a query is one row for each part and
not for each token; a token that shares its place with another is counted too. No member has more in common with the query, so only groups whose
sum reaches the threshold are opened: their members are compared with the query, first by a bitmap
that bounds the symmetric difference from below, then exactly.

Tokens stand in one global order, tokens that are frequent in the corpus last (by rising
frequency), the others by hash. Two sets of similarity t or more must share one of the first
n - ceil(t * n) + 1 tokens of each in this order, so only those enter the matrix. The order
changes the work and never the result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bytescan import blocks, column_bytes, mix
from .common import broadcast_if_small, releasing, staged
from .components import components
from .shingles import shingle_lists

BITS = 1024
#: A shingle is called frequent from this share of the sets on. At most SHARE times the mean set size
#: shingles can be, which bounds the broadcast list (16 bytes each) whatever the number of documents.
SHARE = 10_000
#: Groups of at most so many sets are opened without counting a query's overlap with their whole
#: token union first, as that costs more than looking at their bitmaps.
SMALL = 16
#: Places of a part of a large group's union, and the tokens that a part is made for: an eighth of the
#: places are taken at most, so that few other tokens are counted with them.
PLACES = 1 << 15
PART = 1 << 12

#: Bytes of texts in which a shingle must occur in two sets to be reported.
COUNTED = 1 << 23


def _frequent(docs: DataFrame, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Frequent shingles of the whole corpus and their counts, sorted by shingle: each block of
    texts reports those that several different sets in it have, the sums decide."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = column_bytes(batch.column(0))
            for _, _, part, cuts in blocks(data, offsets, COUNTED):
                seen, lists = set(), []
                for found in shingle_lists(part, cuts, n):
                    found = np.unique(found)
                    key = (len(found), int(found.sum(dtype=np.uint64)))
                    if len(found) and key not in seen:
                        seen.add(key)
                        lists.append(found)
                every = np.concatenate(lists) if lists else np.empty(0, np.uint64)
                del lists
                slot = (every >> np.uint64(44)).astype(np.int32)
                full = np.bincount(slot, minlength=1 << 20)
                every = np.sort(every[full[slot] >= 2])
                first = np.flatnonzero(np.concatenate([np.ones(min(1, len(every)), bool), every[1:] != every[:-1]]))
                times = np.diff(np.append(first, len(every)))
                keep = times >= 2
                yield pa.RecordBatch.from_arrays([pa.array(every[first[keep]].view(np.int64)), pa.array(times[keep])], ["token", "times"])

    counts = docs.select("text").mapInArrow(releasing(count), "token long, times long").groupBy("token").agg(F.sum("times").alias("times"))
    total = docs.count()
    rows = counts.where(F.col("times") >= max(4, total // SHARE)).toPandas()
    tokens = rows["token"].to_numpy(np.int64).view(np.uint64) if len(rows) else np.empty(0, np.uint64)
    order = np.argsort(tokens)
    return tokens[order], rows["times"].to_numpy(np.int64)[order] if len(rows) else np.empty(0, np.int64)


def _ordered(tokens: np.ndarray, hot: np.ndarray, times: np.ndarray) -> np.ndarray:
    if not len(hot) or not len(tokens):
        return tokens
    at = np.minimum(np.searchsorted(hot, tokens), len(hot) - 1)
    warm = hot[at] == tokens
    late = tokens[warm]
    return np.concatenate([tokens[~warm], late[np.lexsort((late, times[at[warm]]))]])


def document_sets(docs: DataFrame, n: int, percent: int) -> DataFrame:
    """(doc_id, n_shingles, k1, k2, prefix array<long>, bits array<long>) of each document; k1 and
    k2 identify the set. Of copies in one batch, only the one of least id has its prefix."""
    spread = docs.sparkSession.sparkContext.broadcast(_frequent(docs, n))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot, times = spread.value
        for batch in batches:
            sizes, one, two, prefixes, bits = [], [], [], [], []
            least: dict[tuple, int] = {}  # the first copy of each set in the batch has its tokens
            names = batch.column(0).to_pylist()
            for found in shingle_lists(*column_bytes(batch.column(1)), n):
                found = np.unique(found)
                m = len(found)
                sizes.append(m)
                one.append(int(found.sum(dtype=np.uint64)))
                two.append(int(mix(found + np.uint64(0x51ED270B)).sum(dtype=np.uint64)))
                name, key = names[len(sizes) - 1], (one[-1], two[-1], m)
                best = least.get(key)
                fresh = bool(m) and name is not None and (best is None or name < names[best])
                if fresh:
                    if best is not None:
                        prefixes[best] = prefixes[best][:0]
                    least[key] = len(sizes) - 1
                prefixes.append(_ordered(found, hot, times)[: m - -(-percent * m // 100) + 1 if fresh else 0].view(np.int64))
                odd = (np.bincount((mix(found) >> np.uint64(54)).astype(np.int64), minlength=BITS) & 1).astype(np.uint8)
                bits.append(np.packbits(odd).view(np.int64))
            lists = [pa.ListArray.from_arrays(np.cumsum([0, *map(len, x)], dtype=np.int32), pa.array(np.concatenate(x) if x else np.empty(0, np.int64))) for x in (prefixes, bits)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(np.array(one, np.uint64).view(np.int64)), pa.array(np.array(two, np.uint64).view(np.int64)), *lists],
                ["doc_id", "n_shingles", "k1", "k2", "prefix", "bits"],
            )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(releasing(scan), "doc_id long, n_shingles long, k1 long, k2 long, prefix array<long>, bits array<long>")


def _full_sets(docs: DataFrame, n: int) -> DataFrame:
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = column_bytes(batch.column(1))
            held, size, begin = [], 0, 0
            for i, found in enumerate(shingle_lists(data, offsets, n)):
                held.append(np.unique(found).view(np.int64))
                size += len(held[-1])
                if size > 1_000_000 or i == batch.num_rows - 1:
                    lists = pa.ListArray.from_arrays(np.cumsum([0, *map(len, held)], dtype=np.int32), pa.array(np.concatenate(held)))
                    yield pa.RecordBatch.from_arrays([batch.column(0).slice(begin, len(held)), lists], ["id", "tokens"])
                    held, size, begin = [], 0, i + 1

    return docs.select("doc_id", "text").mapInArrow(releasing(scan), "id long, tokens array<long>")


def _met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Over rows sorted by (token, set, id): one row for each token and set, if the token has
    several sets. Holds one row between batches."""
    before = waiting = None
    for batch in batches:
        now = np.stack([batch.column(i).to_numpy() for i in range(5)])
        if not now.shape[1]:
            continue
        last = np.concatenate([now[:, :1] if before is None else before, now[:, :-1]], axis=1)
        new_t = now[0] != last[0]
        if before is None:
            new_t[0] = True
        new_c = new_t | (now[1] != last[1])
        group = np.cumsum(new_t)
        several = np.bincount(group[new_c & ~new_t], minlength=group[-1] + 1) > 0
        rows = now[[0, 2, 3, 4]][:, new_c & several[group]]
        if several[0] and waiting is not None:
            rows = np.concatenate([waiting, rows], axis=1)
            waiting = None
        if group[-1] > 0:
            begin = np.flatnonzero(new_t)[-1]
            waiting = None if several[-1] else now[[0, 2, 3, 4]][:, begin : begin + 1]
        before = now[:, -1:]
        yield pa.RecordBatch.from_arrays([pa.array(r) for r in rows], ["token", "id", "n", "pos"])


def _placed(batch: pa.RecordBatch, parts: int, tokens: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, part, place) of all tokens of a batch; ``parts`` and ``tokens`` are the columns that say
    into how many parts a row's tokens are dealt, and which they are."""
    lists = batch.column(tokens)
    row = np.repeat(np.arange(batch.num_rows), lists.value_lengths().to_numpy(zero_copy_only=False))
    mixed = mix(lists.flatten().to_numpy().view(np.uint64) + np.uint64(0x2545F4914F6CDD1D))
    part = (mixed >> np.uint64(20)) % batch.column(parts).to_numpy().astype(np.uint64)[row]
    return row, part.astype(np.int64), (mixed & np.uint64(PLACES - 1)).astype(np.int64)


def _cells(key: np.ndarray, places: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, pa.ListArray]:
    """The distinct keys, which are sorted, and the places of each that are ``wanted``."""
    first = np.flatnonzero(np.concatenate([np.ones(min(1, len(key)), bool), key[1:] != key[:-1]]))
    ends = np.concatenate([[0], np.cumsum(wanted)])[np.append(first, len(key))]
    return key[first], pa.ListArray.from_arrays(ends.astype(np.int32), pa.array(places[wanted].astype(np.int32)))


def _marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Over rows (grp, parts, tokens) of members: for each group and part that a batch has, the places
    of its members' tokens, and those of them that are taken several times."""
    for batch in batches:
        row, part, place = _placed(batch, 1, 2)
        names, group = np.unique(batch.column(0).to_numpy(), return_inverse=True)
        width = int(part.max(initial=0)) + 1
        key, times = np.unique((group[row] * width + part) * PLACES + place, return_counts=True)
        cell, once = _cells(key // PLACES, key % PLACES, times > 0)
        _, again = _cells(key // PLACES, key % PLACES, times > 1)
        yield pa.RecordBatch.from_arrays([pa.array(names[cell // width]), pa.array((cell % width).astype(np.int32)), once, again], ["grp", "part", "once", "again"])


def _unions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Over such rows sorted by group and part: one row each, with a bit for each place that is taken
    and for each that is taken several times. Holds one part between batches."""
    bits = np.zeros((2, PLACES), bool)
    now, done = None, []

    def told() -> pa.RecordBatch:
        lists = [pa.ListArray.from_arrays(np.arange(len(done) + 1, dtype=np.int32) * (PLACES // 64), pa.array(np.concatenate([d[i] for d in done]))) for i in (1, 2)]
        return pa.RecordBatch.from_arrays([pa.array([d[0][0] for d in done], pa.int64()), pa.array([d[0][1] for d in done], pa.int32()), *lists], ["grp", "part", "held", "several"])

    def close() -> None:
        done.append((now, *(np.packbits(b, bitorder="little").view(np.int64) for b in bits)))
        bits[:] = False

    for batch in batches:
        names = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
        once, again = ((c.flatten().to_numpy(), np.concatenate([[0], np.cumsum(c.value_lengths().to_numpy(zero_copy_only=False))])) for c in (batch.column(2), batch.column(3)))
        for i, name in enumerate(names):
            if name != now:
                if now is not None:
                    close()
                if len(done) == 128:
                    yield told()
                    done.clear()
                now = name
            taken = once[0][once[1][i] : once[1][i + 1]]
            bits[1, taken] |= bits[0, taken]
            bits[0, taken] = True
            bits[1, again[0][again[1][i] : again[1][i + 1]]] = True
    if now is not None:
        close()
        yield told()


def _places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Over rows (a, own, grp, parts, tokens) of queries: one for each part that has tokens, with the
    place of each token."""
    for batch in batches:
        row, part, place = _placed(batch, 3, 4)
        width = int(part.max(initial=0)) + 1
        order = np.argsort(row * width + part, kind="stable")
        cell, lists = _cells((row * width + part)[order], place[order], np.ones(len(order), bool))
        of = [pa.array(batch.column(i).to_numpy()[cell // width]) for i in range(3)]
        yield pa.RecordBatch.from_arrays([*of, pa.array((cell % width).astype(np.int32)), lists], ["a", "own", "grp", "part", "places"])


def _apart(left: str, right: str) -> F.Column:
    """Least symmetric difference that two bitmaps allow."""
    return sum((F.bit_count(F.col(left)[i].bitwiseXOR(F.col(right)[i])) for i in range(BITS // 64)), F.lit(0))


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The (a, b) of ``pairs`` whose whole sets are similar enough."""
    left = sets.select(F.col("id").alias("a"), F.col("tokens").alias("ta"))
    right = sets.select(F.col("id").alias("b"), F.col("tokens").alias("tb"))
    both = F.size(F.array_intersect("ta", "tb"))
    return pairs.select("a", "b").join(left, "a").join(right, "b").where(100 * both >= percent * (F.size("ta") + F.size("tb") - both)).select("a", "b")


def _reach(percent: int, x: F.Column, y: F.Column) -> F.Column:
    """The overlap that two sizes need, in whole numbers."""
    need = percent * (x + y) + F.lit(99 + percent)
    return ((need - need % (100 + percent)) / (100 + percent)).cast("long")


def _shared_least(percent: int, x: F.Column, y: F.Column) -> F.Column:
    """How many common prefix tokens two sizes need: a common token that isn't in both prefixes
    lies beyond the prefix that ends first."""
    most = F.greatest(x, y)
    beyond = (percent * most + 99 - (percent * most + 99) % 100) / 100 - 1
    return _reach(percent, x, y) - beyond.cast("long")


def _sizes(percent: int) -> tuple[F.Column, F.Column]:
    """The sizes that partners of a query may have, of those that its group's members have."""
    low = F.greatest(F.col("least"), ((percent * F.col("na") + 99) / 100).cast("long"))
    high = F.least(F.col("most"), (100 * F.col("na") / percent).cast("long"))
    return F.least(low, high), F.greatest(low, high)


def _leaders(entries: DataFrame, h: DataFrame) -> DataFrame:
    """(a, b, led): the leader other than itself that a set shares most prefix tokens with, and how
    many, or 0 if it shares more with itself as a leader. A token's leader is the set with the most shared
    prefix tokens that has it."""
    known = entries.select("token", "id").join(h, "id")
    lead = known.groupBy("token").agg(F.max(F.struct("h", (-F.col("id")).alias("minus"))).alias("m")).select("token", F.col("m.h").alias("hl"), (-F.col("m.minus")).alias("leader"))
    votes = entries.select("token", "id").join(lead, "token").groupBy("id", "leader").agg(F.count("*").alias("c"), F.first("hl").alias("hl"))
    vote = F.struct("c", "hl", (-F.col("leader")).alias("minus"))
    best = votes.groupBy("id").agg(F.max(vote).alias("m"), F.max(F.when(F.col("id") != F.col("leader"), vote)).alias("other"))
    return best.where("other is not null").select(F.col("id").alias("a"), (-F.col("other.minus")).alias("b"), F.when(F.col("m") == F.col("other"), F.col("m.c")).otherwise(0).alias("led"))


def _qualified(member: DataFrame, percent: int) -> DataFrame:
    """(a, na, comp, own, grp, least, most): groups whose prefix tokens a query shares often
    enough for some size of their members. A query asks groups of larger name than its own, the
    others are found by their members, and its own group, where its own tokens don't count. A group
    of which all that the query meets is in its component already has nothing to tell."""
    matrix = member.groupBy("token", "grp").agg(
        F.count("*").alias("c"), F.min("n").alias("least"), F.max("n").alias("most"), F.max(F.col("n") - F.col("pos")).alias("left"), F.max("h").alias("top"), F.min("comp").alias("lo"), F.max("comp").alias("hi")
    )
    live = matrix.groupBy("token").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).where("lo <> hi").select("token")
    asking = member.join(live, "token", "left_semi").select(F.col("id").alias("a"), F.col("n").alias("na"), (F.col("n") - F.col("pos")).alias("la"), F.col("h").alias("ha"), "token", F.col("grp").alias("own"), "comp")
    low, high = _sizes(percent)
    # Of the sizes that partners may have, the most unequal ones need the fewest common tokens, give
    # or take one for rounding.
    fewest = F.least(_shared_least(percent, F.col("na"), low), _shared_least(percent, F.col("na"), high)) - F.when(low == high, 0).otherwise(1)
    met = asking.join(matrix, "token").where(
        ((F.col("grp") > F.col("own")) | ((F.col("grp") == F.col("own")) & (F.col("c") > 1)))
        & ((F.col("lo") != F.col("comp")) | (F.col("hi") != F.col("comp")))
        & (100 * F.col("na") >= percent * F.col("least"))
        & (100 * F.col("most") >= percent * F.col("na"))
        & (F.least("ha", "top") >= fewest)
    )
    # The first common token leaves enough of both sets; the later ones need not.
    early = F.max(F.least("la", "left") >= _reach(percent, F.col("na"), F.col("least"))).alias("early")
    met = met.groupBy("a", "na", "comp", "own", "grp").agg(F.count("*").alias("shared"), early, F.min("least").alias("least"), F.max("most").alias("most"))
    return met.where(F.col("early") & (F.col("shared") >= fewest)).drop("shared", "early")


def _differing(inner: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) inside large groups that may be similar, from members (id, n, comp, grp, home,
    asks) of which those that ask haven't the group's home component.

    Each member is told by what it adds to its leader's set and what it lacks of it. With r tokens
    in the leader's set, of which x and y lack d and e, they have r - d - e plus the differences in
    common, so they need a number of common differences, and one of them in the first few of each,
    rarest in the group first. Members that may need none meet all others of their group."""
    part = 100 + percent
    leader = sets.select(F.col("id").alias("grp"), F.col("tokens").alias("all"))
    told = inner.join(sets, "id").join(leader, "grp").withColumn("lacks", F.array_except("all", "tokens"))
    told = told.select("id", "n", "comp", "grp", "home", "asks", F.concat(F.array_except("tokens", "all"), F.transform("lacks", lambda t: F.bitwise_not(t))).alias("diff"), (F.lit(percent) * F.col("n") + part * (F.size("lacks") - F.size("all"))).alias("weight"), (part * F.size("all")).alias("whole"))
    told = staged(told, "differences")
    floor = told.groupBy("grp").agg(F.min("weight").alias("any"), F.min(F.when(F.col("asks"), F.col("weight"))).alias("asking"))
    # ceil((percent * (n + m) + part * (d + e)) / part) - r, for the easiest partner
    sum_ = F.col("weight") + F.when(F.col("asks"), F.col("any")).otherwise(F.col("asking")) + F.col("whole")
    told = told.join(floor, "grp").withColumn("need", F.ceil(sum_ / part)).drop("weight", "whole", "any", "asking")
    rows = told.where("need > 0").select("id", "grp", "need", F.explode("diff").alias("token"))
    rare = rows.groupBy("grp", "token").agg(F.count("*").alias("c"))
    first = rows.join(rare, ["grp", "token"]).groupBy("id", "need").agg(F.sort_array(F.collect_list(F.struct("c", "token"))).alias("order"))
    first = first.select("id", F.explode(F.slice("order", F.lit(1), F.greatest(F.lit(0), F.size("order") - F.col("need") + 1).cast("int"))).alias("o")).select("id", "o.token")
    who = told.drop("diff")
    spots = first.join(who, "id")
    side = lambda df, a, n, c: df.select(F.col("id").alias(a), F.col("n").alias(n), F.col("comp").alias(c), "grp", "home", "asks", "token")
    likely = (F.col("ca") != F.col("cb")) & (100 * F.least("na", "nb") >= percent * F.greatest("na", "nb")) & (~F.col("asks_b") | (F.col("a") < F.col("b")))
    left = side(spots.where("asks"), "a", "na", "ca").drop("home", "asks")
    right = side(spots, "b", "nb", "cb").withColumnRenamed("asks", "asks_b").drop("home")
    pairs = left.join(right, ["grp", "token"]).where(likely).select("a", "b")
    loose = who.withColumn("token", F.lit(0).cast("long"))
    some, every = side(loose.where("asks"), "a", "na", "ca").drop("home", "asks", "token"), side(loose, "b", "nb", "cb").withColumnRenamed("asks", "asks_b").drop("home", "token")
    easy = told.where("need <= 0").select("id")
    easy_pairs = some.join(easy.withColumnRenamed("id", "a"), "a", "left_semi").join(every, "grp").union(some.join(every.join(easy.withColumnRenamed("id", "b"), "b", "left_semi"), "grp").select("grp", "a", "na", "ca", "b", "nb", "cb", "asks_b"))
    # either of two that ask may be the one that needs nothing
    easy_pairs = easy_pairs.where((F.col("ca") != F.col("cb")) & (100 * F.least("na", "nb") >= percent * F.greatest("na", "nb"))).select("a", "b")
    return pairs.union(easy_pairs).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def jaccard_links(docs: DataFrame, n: int = 4, percent: int = 85) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(documents, links, components): every document with its set size and class, the links found
    between classes, and the component of each linked class. Links that could only join classes
    of one component already known are not sought again."""
    base = staged(document_sets(docs, n, percent), "sets")
    full = base.where("n_shingles > 0 and doc_id is not null")
    classes = full.groupBy("k1", "k2", "n_shingles").agg(F.min("doc_id").alias("id"), F.count("*").alias("copies"))
    # Positions in the order, for tokens that several sets share. A set's first document stands
    # for it; two copies from different batches meet under each token and leave one row.
    places = full.select(F.posexplode("prefix").alias("pos", "token"), F.xxhash64("k1", "k2", "n_shingles").alias("set"), "doc_id", "n_shingles").select("token", "set", "doc_id", "n_shingles", F.col("pos").cast("long"))
    places = places.repartition("token").sortWithinPartitions("token", "set", "doc_id")
    entries = staged(places.mapInArrow(releasing(_met), "token long, id long, n long, pos long"), "matrix")
    # h: how many tokens of its prefix a class shares with any other class; it has no more in
    # common with any single one.
    h = staged(entries.groupBy("id").agg(F.count("*").alias("h")), "involved")
    kept = staged(full.select(F.col("doc_id").alias("id"), F.col("n_shingles").alias("n"), "bits").join(h, "id", "left_semi").dropDuplicates(["id"]), "classes")
    texts = docs.select(F.col("doc_id").cast("long"), "text")

    def sets_of(ids: DataFrame) -> DataFrame:
        """The whole sets of some classes. Their ids are a written table, so a small one is
        broadcast and the texts stay where they are."""
        ids = staged(ids.distinct(), "ids")
        return staged(_full_sets(texts.join(broadcast_if_small(ids), "doc_id", "left_semi"), n).dropDuplicates(["id"]), "tokens")

    def ends_of(pairs: DataFrame) -> DataFrame:
        return pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b"))

    def measured(pairs: DataFrame) -> DataFrame:
        """Distinct pairs with their sizes and the distance of their bitmaps."""
        out = pairs.distinct()
        out = out.join(kept.select(F.col("id").alias("a"), F.col("n").alias("na"), F.col("bits").alias("x")), "a")
        out = out.join(kept.select(F.col("id").alias("b"), F.col("n").alias("nb"), F.col("bits").alias("y")), "b")
        return out.withColumn("apart", _apart("x", "y")).drop("x", "y")

    def near(pairs: DataFrame) -> DataFrame:
        """Those that sizes and bitmaps allow."""
        allowed = (100 * F.least("na", "nb") >= percent * F.greatest("na", "nb")) & (F.col("apart") <= F.col("na") + F.col("nb") - 2 * _reach(percent, F.col("na"), F.col("nb")))
        return pairs.where(allowed).select("a", "b", "na", "nb", "apart")

    def narrowed(pairs: DataFrame) -> DataFrame:
        """Pairs whose prefixes share enough tokens. A common token that isn't in both prefixes
        lies beyond the prefix that ends first, so the overlap is at most the common prefix tokens
        and the rest of one set."""
        ids = staged(ends_of(pairs).distinct(), "ids")
        own = staged(full.where(F.size("prefix") > 0).select("doc_id", "prefix").join(broadcast_if_small(ids), "doc_id", "left_semi").dropDuplicates(["doc_id"]), "prefixes")
        out = pairs.join(own.select(F.col("doc_id").alias("a"), F.col("prefix").alias("x")), "a").join(own.select(F.col("doc_id").alias("b"), F.col("prefix").alias("y")), "b")
        rest = F.greatest(F.col("na") - F.size("x"), F.col("nb") - F.size("y"))
        return out.where(F.size(F.array_intersect("x", "y")) + rest >= _reach(percent, F.col("na"), F.col("nb"))).select("a", "b", "apart")

    # 1. Groups of sets that look like their leader (by the bitmaps, a third of all tokens apart at
    # most, and a quarter of the prefix shared), and links of each set to a leader.
    tied = staged(measured(_leaders(entries, h)), "leaders")
    groups = tied.where((400 * F.col("led") >= (100 - percent) * F.col("na")) & (3 * F.col("apart") <= F.col("na") + F.col("nb"))).select(F.col("a").alias("id"), F.col("b").alias("grp"))
    stars = staged(narrowed(near(tied)), "near")
    links = staged(_verified(stars, sets_of(ends_of(stars)), percent), "links")
    label = components(links, "a", "b")
    named = kept.select("id", "n").join(groups, "id", "left").join(label.withColumnRenamed("node", "id"), "id", "left")
    named = staged(named.select("id", "n", F.coalesce("grp", "id").alias("grp"), F.coalesce("component", "id").alias("comp")), "groups")

    # 2. The matrix over prefix tokens bounds the overlap of each query and group from above.
    member = staged(entries.join(named.drop("n"), "id").join(h, "id"), "members")
    asked = staged(_qualified(member, percent), "asked")

    # 3. Inside one group the sets of the component that most of them are in needn't be compared
    # with each other, so only the others ask.
    homes = asked.where("own = grp").groupBy("grp", "comp").count().groupBy("grp").agg(F.max(F.struct("count", "comp")).alias("m")).select("grp", F.col("m.comp").alias("home"))
    away = asked.where("own = grp").join(homes, "grp").where("comp <> home")
    queries = staged(away.select(*asked.columns, "home").union(asked.where("own <> grp").withColumn("home", F.lit(None).cast("long"))), "queries")
    # For large groups the overlap with the union of all their members' tokens is counted.
    large = staged(named.groupBy("grp").count().where(F.col("count") > SMALL).select("grp").join(queries.select("grp").distinct(), "grp", "left_semi"), "large")
    met = None
    if not large.isEmpty():
        large = broadcast_if_small(large)
        wide = queries.join(large, "grp", "left_semi")
        inside = named.join(large, "grp", "left_semi").select("id", "n", "grp")
        sets = sets_of(inside.select(F.col("id").alias("doc_id")).union(wide.select("a")).union(inside.select("grp")))
        # About as many tokens as members have apart from the leader come to its own.
        spread = inside.join(tied.select(F.col("a").alias("id"), "apart"), "id", "left").groupBy("grp").agg((F.max("n") + F.coalesce(F.sum("apart"), F.lit(0))).alias("size"))
        parts = broadcast_if_small(staged(spread.select("grp", F.ceil(F.col("size") / PART).cast("int").alias("parts")), "parts"))
        marks = inside.join(sets, "id").join(parts, "grp").select("grp", "parts", "tokens").mapInArrow(releasing(_marks), "grp long, part int, once array<int>, again array<int>")
        unions = marks.repartition("grp", "part").sortWithinPartitions("grp", "part").mapInArrow(releasing(_unions), "grp long, part int, held array<long>, several array<long>")
        unions = broadcast_if_small(staged(unions, "unions"), 512)
        places = wide.join(sets.withColumnRenamed("id", "a"), "a").join(parts, "grp").select("a", "own", "grp", "parts", "tokens").mapInArrow(releasing(_places), "a long, own long, grp long, part int, places array<int>")
        bits = F.when(F.col("grp") == F.col("own"), F.col("several")).otherwise(F.col("held"))
        spots = places.join(unions, ["grp", "part"]).select("a", "grp", "places", bits.alias("bits"))
        inside_ = F.size(F.filter("places", lambda p: F.getbit(F.get("bits", F.shiftright(p, 6)), F.pmod(p, F.lit(64))) == 1))
        held = spots.groupBy("a", "grp").agg(F.sum(inside_).alias("overlap"))
        # The smallest partner needs the least overlap (give or take one for rounding).
        fits = wide.join(held, ["a", "grp"]).where(F.col("overlap") >= _reach(percent, F.col("na"), _sizes(percent)[0]) - 1)
        fits = staged(fits.select(*queries.columns), "queries")
        # Inside them, sets meet by what tells them from the leader.
        asks = fits.where("own = grp")
        inner = asked.where("own = grp").join(asks.select("grp", "home").distinct(), "grp").join(asks.select("a", F.lit(True).alias("asks")), "a", "left")
        inner = inner.select(F.col("a").alias("id"), F.col("na").alias("n"), "comp", "grp", "home", F.coalesce("asks", F.lit(False)).alias("asks"))
        met = _differing(inner, sets, percent)
        queries = staged(queries.join(large, "grp", "left_anti").select(*queries.columns).union(fits.where("own <> grp")), "queries")

    # 4. What is left of the groups is opened.
    left = queries.select("a", "na", F.col("comp").alias("ca"), "own", "grp", "home")
    likely = (F.col("ca") != F.col("cb")) & (100 * F.least("na", "nb") >= percent * F.greatest("na", "nb"))
    across = left.where("own <> grp").join(named.select(F.col("id").alias("b"), F.col("n").alias("nb"), F.col("comp").alias("cb"), "grp"), "grp").where(likely).select("a", "b")
    inner = asked.where("own = grp").select(F.col("a").alias("b"), F.col("na").alias("nb"), F.col("comp").alias("cb"), "grp")
    within = left.where("own = grp").join(inner, "grp").where(likely & ((F.col("cb") == F.col("home")) | (F.col("a") < F.col("b")))).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    opened = across.union(within) if met is None else across.union(within).union(met)
    pairs = staged(narrowed(staged(near(measured(opened)), "opened")), "opened")

    # 5. The most alike pair of each set and component first: for most that settles it.
    def regrouped(named: DataFrame, more: DataFrame) -> DataFrame:
        """Components after further links: only those that these join are looked at."""
        ends = more.join(named.select(F.col("id").alias("a"), F.col("comp").alias("ga")), "a").join(named.select(F.col("id").alias("b"), F.col("comp").alias("gb")), "b")
        label = components(ends, "ga", "gb")
        return staged(named.join(label.withColumnRenamed("node", "comp"), "comp", "left").select("id", F.coalesce("component", "comp").alias("comp")), "groups")

    sets = sets_of(ends_of(pairs))
    best = pairs.join(named.select(F.col("id").alias("b"), "comp"), "b").groupBy("a", "comp").agg(F.min(F.struct("apart", "b")).alias("m")).select("a", F.col("m.b").alias("b"))
    found = staged(_verified(best, sets, percent), "links")
    named = regrouped(named, found)
    open_yet = pairs.join(named.select(F.col("id").alias("a"), F.col("comp").alias("ga")), "a").join(named.select(F.col("id").alias("b"), F.col("comp").alias("gb")), "b").where("ga <> gb")
    last = staged(_verified(open_yet, sets, percent), "links")
    named = regrouped(named, last)
    out = _class_ids(base, staged(classes, "class-ids"))
    return out, links.union(found).union(last), named.select(F.col("id").alias("node"), F.col("comp").alias("component"))


def _class_ids(base: DataFrame, classes: DataFrame, share: int = 2000) -> DataFrame:
    """(doc_id, n_shingles, class_id). Classes that hold one in ``share`` of all documents, at most
    ``share`` of them, are broadcast, so that their many copies stay where they are."""
    keys = ["k1", "k2", "n_shingles"]
    least = max(2, base.count() // share)
    known = classes.select(*keys, F.col("id").alias("class_id"), "copies")
    many = F.broadcast(known.where(F.col("copies") > least).select(*keys, F.col("class_id").alias("many_id")))
    first = base.select("doc_id", *keys).join(many, keys, "left")
    done = first.where("many_id is not null").select("doc_id", "n_shingles", F.col("many_id").alias("class_id"))
    rest = first.where("many_id is null").drop("many_id").join(known.where(F.col("copies") <= least).drop("copies"), keys, "left").select("doc_id", "n_shingles", "class_id")
    return done.union(rest)


def jaccard_components(docs: DataFrame, n: int = 4, percent: int = 85) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of ``docs`` (doc_id, text).

    Null and wordless texts have n_shingles 0 and are their own component. Exact copies share a
    class, so copies cost one row each. Rows with a null doc_id come back with a null component
    and link with nothing. Rows that repeat a doc_id come back each; when their texts differ, the
    links of all hold for that doc_id. Further columns are ignored. No rows give no rows.
    """
    named, _, label = jaccard_links(docs, n, percent)
    out = named.join(label.select(F.col("node").alias("class_id"), "component"), "class_id", "left")
    return out.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "class_id", "doc_id")).alias("component_id"))
