"""N-gram Jaccard self-join by set-relation skipping, down to components.

Two texts link when their sets of word shingles have a Jaccard similarity of
at least 0.75.  The join is exact; its result is each row's component.

1. *Order.*  Shingles are ordered by hash, those that open many sets (counted
   over all rows) last.  Any order gives the same result; this one keeps
   passages that many texts share out of the indexed prefixes.
2. *Index with position blocks.*  Similar sets share a shingle among the first
   quarter of the larger and the first seventh of the smaller (prefix filter).
   Every such shingle goes, with its position and set size, to an index list.
   Lists are sorted by size; blocks of a list whose positions and sizes can't
   reach the overlap are skipped whole.
3. *Answers from similar sets.*  Sets that meet in long lists form crowds: each
   list elects the member that is in most lists, each member follows the one
   that most of its lists elect.  In a crowd, answers are derived from those of
   a set similar to this one: |x & y| = |h & y| - |(h - x) & y| + |(x - h) & y|,
   so only the lists of the two small differences are read.  As components are
   wanted, sets already reached are left out of every further answer.
4. Pairs of short lists, and pairs of long ones across crowds, whose ends are
   not yet in one component are verified, and the components joined once more.

A large crowd is first compared with its hub, member by member.  What links to
the hub is one component; the rest is searched in blocks, among itself and
against those members that can be near it: Jaccard distance is a metric, so a
member nearer to the hub than the rest's least distance less the limit has no
link to it.

Equal sets are one class from the start (a 128-bit fingerprint, of which the
first half names the class, or the second where two sets share the first).
Texts are read again where sets are needed, never whole sets shuffled.

Defined cases: null text or no words: empty set, linked with nothing, its own
component; fewer words than ``k``: the whole sequence is the one shingle; rows
with a null ``doc_id`` link nothing and have a null component; rows that share
a ``doc_id`` are one node; an empty table gives an empty result; other columns
don't matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import parts_for, small, small_batches, staged
from .components import components
from .shingles import mix, shingle_sets, slices

K = 5
#: Similarity as a fraction: 100 * intersection >= 75 * union.
NUM, DEN = 75, 100
#: Shingles that open at least so many sets go last in the order, the commonest
#: COMMON_KEPT of them (a bound on memory; the order never changes the result).
COMMON, COMMON_KEPT = 8, 1 << 16
#: Index lists up to this length give their pairs at once; longer ones make crowds.
SHORT = 16
#: Sets compared with one hub in one place; members of a crowd in one block.
SPOKES, CROWD_BLOCK = 256, 1024
#: Places that the members of one long list are dealt to.
LIST_SALTS = 32
_LOW = np.uint64(0xFFFFFFFF)
_U32, _U16 = np.uint64(32), np.uint64(0xFFFF)


def probe_length(n):
    """A set of n shingles shares one of so many first ones with any similar, not larger set."""
    return n - -(-NUM * n // DEN) + 1


def index_length(n):
    """... and of so many with any similar, not smaller set."""
    return n - -(-2 * NUM * n // (NUM + DEN)) + 1


def overlap_needed(m, n):
    """Least intersection of similar sets of m and n shingles."""
    return -(-NUM * (m + n) // (NUM + DEN))


def fingerprint(s: np.ndarray) -> tuple[int, int]:
    a, b = mix(s ^ np.uint64(0xA5A5A5A5DEADBEEF)), mix(s + np.uint64(0x1234567890ABCDEF))
    x = mix(np.array([a.sum(dtype=np.uint64) + np.uint64(len(s)), b.sum(dtype=np.uint64) ^ np.uint64(len(s))]))
    return int(x[:1].view(np.int64)[0]), int(x[1:].view(np.int64)[0])


def class_of(s: np.ndarray, shared: frozenset[int]) -> int:
    """Class of a set: the first half of its fingerprint, unless other sets share it."""
    first, second = fingerprint(s)
    return second if first in shared else first


def token_keys(s: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and 32-bit key of shingles, from bits that don't decide the hash order."""
    return ((s >> _U32) & _U16) % np.uint64(buckets), (s & _LOW).astype(np.uint32)


def _sliced(bucket: np.ndarray, buckets: int, *arrays: np.ndarray) -> Iterator[tuple[int, list[np.ndarray]]]:
    order = np.argsort(bucket, kind="stable")
    ends = np.searchsorted(bucket[order], np.arange(buckets + 1))
    for i in np.flatnonzero(np.diff(ends)).tolist():
        part = order[ends[i] : ends[i + 1]]
        yield i, [a[part] for a in arrays]


SCAN = "kind int, doc_id long, n long, cls long, check long, bucket int, keys binary"


def _scan(buckets: int):
    """Rows of two kinds: 0 = a text's set size and class; 1 = keys of prefix shingles, by bucket."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            sizes, cls, check, prefixes = [], [], [], []
            for s in shingle_sets(b.column("text"), K):
                c, d = fingerprint(s)
                sizes.append(len(s))
                cls.append(c)
                check.append(d)
                prefixes.append(s[: probe_length(len(s))] if len(s) else s)
            m = b.num_rows
            null = lambda t, k: pa.nulls(k, t)
            yield pa.RecordBatch.from_arrays(
                [pa.array([0] * m, pa.int32()), b.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(cls, pa.int64()), pa.array(check, pa.int64()), null(pa.int32(), m), null(pa.binary(), m)],
                names=["kind", "doc_id", "n", "cls", "check", "bucket", "keys"],
            )
            tokens = np.concatenate(prefixes) if prefixes else np.zeros(0, np.uint64)
            if len(tokens):
                bucket, key = token_keys(tokens, buckets)
                got = [(i, k.tobytes()) for i, (k,) in _sliced(bucket, buckets, key)]
                g = len(got)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([1] * g, pa.int32()), *(null(pa.int64(), g) for _ in range(4)), pa.array([i for i, _ in got], pa.int32()), pa.array([k for _, k in got], pa.binary())],
                    names=["kind", "doc_id", "n", "cls", "check", "bucket", "keys"],
                )

    return scan


def _count(key: tuple[pa.Scalar, ...], t: pa.Table) -> pa.Table:
    keys = np.frombuffer(b"".join(t.column("keys").to_pylist()), np.uint32)
    keys, counts = np.unique(keys, return_counts=True)
    often = counts >= COMMON
    bucket = np.int64(key[0].as_py()) << np.int64(32)
    return pa.table({"token": pa.array(bucket | keys[often].astype(np.int64)), "sets": pa.array(counts[often], pa.int64())})


def ordered_prefix(s: np.ndarray, late: np.ndarray) -> np.ndarray:
    """The first shingles of a set in the order (late, hash)."""
    p = probe_length(len(s))
    if late[:p].any():
        s = np.concatenate((s[~late], s[late]))
    return s[:p]


INDEX = "bucket int, keys binary, owners binary, places binary, cls binary, sizes binary"


def _index(buckets: int, common: np.ndarray, shared: frozenset[int]):
    table = np.zeros(1 << 22, bool)
    table[(common & ((1 << 22) - 1)).astype(np.int64)] = True

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            seen, cls, sizes, prefixes = set(), [], [], []
            for s in shingle_sets(b.column("text"), K):
                if not len(s):
                    continue
                c = class_of(s, shared)
                if c in seen:
                    continue
                seen.add(c)
                if len(common):
                    bucket, key = token_keys(s, buckets)
                    maybe = np.flatnonzero(table[(key & np.uint32((1 << 22) - 1)).astype(np.int64)])
                    late = np.zeros(len(s), bool)
                    if len(maybe):
                        token = (bucket[maybe].astype(np.int64) << np.int64(32)) | key[maybe].astype(np.int64)
                        at = np.searchsorted(common, token)
                        late[maybe] = common[np.minimum(at, len(common) - 1)] == token
                    s_prefix = ordered_prefix(s, late)
                else:
                    s_prefix = s[: probe_length(len(s))]
                cls.append(c)
                sizes.append(len(s))
                prefixes.append(s_prefix)
            if not cls:
                continue
            lengths = np.array([len(p) for p in prefixes])
            owner = np.repeat(np.arange(len(cls)), lengths)
            place = np.arange(len(owner)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
            bucket, key = token_keys(np.concatenate(prefixes), buckets)
            cls_, sizes_ = np.array(cls, np.int64), np.array(sizes, np.uint32)
            rows = []
            for i, (k, o, p) in _sliced(bucket, buckets, key, owner, place):
                new = np.concatenate(([True], o[1:] != o[:-1]))  # owners ascend
                own = o[new]
                rows.append((i, k.tobytes(), (np.cumsum(new) - 1).astype(np.uint32).tobytes(), p.astype(np.uint32).tobytes(), cls_[own].tobytes(), sizes_[own].tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int32() if not j else pa.binary()) for j, c in enumerate(zip(*rows))], names=[x.split()[0] for x in INDEX.split(", ")])

    return index


def block_pairs(n: np.ndarray, place: np.ndarray, block: int = 64) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (smaller, larger) of one index list, sorted by size, that can still
    be similar: the smaller's place is in its index prefix, sizes are near, and
    what follows the two places can hold the overlap.  Pairs of blocks whose
    best values can't are skipped whole."""
    f = len(n)
    indexed, after = place < index_length(n), n - place
    starts = range(0, f, block)
    reach = [int(after[s : s + block].max()) for s in starts]
    for x, s in enumerate(starts):
        larger = slice(s, min(f, s + block))
        for y in range(x, -1, -1):
            t = y * block
            e = min(f, t + block)
            if DEN * int(n[e - 1]) < NUM * int(n[s]):
                break  # sizes only shrink from here
            if min(reach[x], reach[y]) < overlap_needed(int(n[t]), int(n[s])):
                continue
            i, j = np.arange(t, e)[:, None], np.arange(s, larger.stop)[None, :]
            ok = (i < j) & (DEN * n[i] >= NUM * n[j]) & (indexed[i] | (indexed[j] & (n[i] == n[j])))
            ok &= np.minimum(after[i], after[j]) >= overlap_needed(n[i], n[j])
            i, j = np.nonzero(ok)
            if len(i):
                yield i + t, j + s


FOUND = "a long, b long, shared long, members binary, places binary, sizes binary"


def _lists(t: pa.Table) -> pa.Table:
    """The index lists of one bucket: pairs of short lists (a, b, shared), and long
    lists themselves."""
    part = lambda name, kind: [np.frombuffer(x, kind) for x in t.column(name).to_pylist()]
    keys, owners, cls, sizes = part("keys", np.uint32), part("owners", np.uint32), part("cls", np.int64), part("sizes", np.uint32)
    key_ = np.concatenate(keys)
    place = np.concatenate(part("places", np.uint32)).astype(np.int64)
    own = np.concatenate([c[o] for c, o in zip(cls, owners)])
    n = np.concatenate([s[o] for s, o in zip(sizes, owners)]).astype(np.int64)
    # shingles that only one row has are most of all: out before the full sort
    order = np.argsort(key_, kind="stable")
    k = key_[order]
    twice = np.concatenate((k[1:] == k[:-1], [False]))
    twice[1:] |= twice[:-1].copy()
    order = order[twice]
    key_, place, own, n = key_[order], place[order], own[order], n[order]
    order = np.lexsort((own, n, key_))
    key_, place, own, n = key_[order], place[order], own[order], n[order]
    first = np.ones(len(key_), bool)  # a class once in a list
    first[1:] = (key_[1:] != key_[:-1]) | (own[1:] != own[:-1])
    key_, place, own, n = key_[first], place[first], own[first], n[first]
    starts = np.flatnonzero(np.concatenate(([True], key_[1:] != key_[:-1]))) if len(key_) else np.zeros(0, np.int64)
    lengths = np.diff(np.append(starts, len(key_)))
    left, right, long_lists = [], [], []
    indexed, after = place < index_length(n), n - place
    for f in np.unique(lengths[(lengths > 1) & (lengths <= SHORT)]).tolist():
        at = starts[lengths == f][:, None]
        x, y = np.triu_indices(f, 1)
        i, j = (at + x).ravel(), (at + y).ravel()
        ok = (DEN * n[i] >= NUM * n[j]) & (indexed[i] | (indexed[j] & (n[i] == n[j])))
        ok &= np.minimum(after[i], after[j]) >= overlap_needed(n[i], n[j])
        left.append(own[i[ok]])
        right.append(own[j[ok]])
    for s, f in zip(starts[lengths > SHORT].tolist(), lengths[lengths > SHORT].tolist()):
        long_lists.append((own[s : s + f].tobytes(), place[s : s + f].astype(np.uint32).tobytes(), n[s : s + f].astype(np.uint32).tobytes()))
    a, b = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (left, right))
    a, b = np.minimum(a, b), np.maximum(a, b)
    order = np.lexsort((b, a))
    a, b = a[order], b[order]
    new = np.flatnonzero(np.concatenate(([True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])))) if len(a) else np.zeros(0, np.int64)
    shared = np.diff(np.append(new, len(a)))
    g, m = len(new), len(long_lists)
    number = lambda x: pa.concat_arrays([pa.array(x, pa.int64()), pa.nulls(m, pa.int64())])
    binary = lambda c: pa.concat_arrays([pa.nulls(g, pa.binary()), pa.array([x[c] for x in long_lists], pa.binary())])
    return pa.table({"a": number(a[new]), "b": number(b[new]), "shared": number(shared), "members": binary(0), "places": binary(1), "sizes": binary(2)})


VERIFIED = "a long, b long, na long, nb long, inter long"


def similar(inter, m, n):
    return DEN * inter >= NUM * (m + n - inter)


def _compare(shared: frozenset[int]):
    """Spokes against their hubs; several hubs share a group."""

    def compare(t: pa.Table) -> pa.Table:
        sets = _sets(t, shared)
        out = []
        for h, c in zip(t.column("hub").to_pylist(), t.column("cls").to_pylist()):
            if h != c and h in sets and c in sets:
                out.append((c, h, len(sets[c]), len(sets[h]), len(np.intersect1d(sets[h], sets[c], True))))
        cols = list(zip(*out)) or [[]] * 5
        return pa.table({name: pa.array(c, pa.int64()) for name, c in zip(["a", "b", "na", "nb", "inter"], cols)})

    return compare


def _sets(t: pa.Table, shared: frozenset[int]) -> dict[int, np.ndarray]:
    """Sets by class; rows whose text is another's (of the same doc_id) are passed over."""
    out: dict[int, np.ndarray] = {}
    for c, s in zip(t.column("cls").to_pylist(), shingle_sets(t.column("text"), K)):
        if c not in out and len(s) and class_of(s, shared) == c:
            out[c] = s
    return out


def reach(sets: list[np.ndarray]) -> list[tuple[int, int]]:
    """Links that join the sets' components (a spanning forest), by search from
    the set with most company.  Intersections with all others come from the
    lists of a set's shingles; those of a set near the start from the start's
    and the lists of the differences alone."""
    n = np.array([len(s) for s in sets])
    shingles, where = np.unique(np.concatenate(sets), return_inverse=True)
    ends = np.cumsum(n)
    own = [where[e - k : e] for e, k in zip(ends.tolist(), n.tolist())]  # ascending numbers
    members = np.repeat(np.arange(len(sets)), n)[np.argsort(where, kind="stable")]
    count = np.bincount(where, minlength=len(shingles))
    first = np.concatenate(([0], np.cumsum(count)))

    def met(tokens: np.ndarray) -> np.ndarray:
        """How many of the tokens each set has."""
        k = count[tokens]
        inside = np.arange(int(k.sum())) - np.repeat(np.cumsum(k) - k, k)
        return np.bincount(members[np.repeat(first[tokens], k) + inside], minlength=len(sets))

    company = np.array([int(count[o].sum()) for o in own])
    left, links = np.ones(len(sets), bool), []
    for start in np.argsort(-company, kind="stable").tolist():
        if not left[start]:
            continue
        left[start] = False
        base, todo = met(own[start]), [start]
        while todo and left.any():
            x = todo.pop()
            if x == start:
                inter = base
            else:
                lost, won = np.setdiff1d(own[start], own[x], True), np.setdiff1d(own[x], own[start], True)
                near = count[lost].sum() + count[won].sum() < count[own[x]].sum()
                inter = base - met(lost) + met(won) if near else met(own[x])
            hits = np.flatnonzero(left & similar(inter, n[x], n))
            left[hits] = False
            links += [(x, y) for y in hits.tolist()]
            todo += hits.tolist()
    return links


def _crowds(shared: frozenset[int]):
    """Links of the crowds (or pairs of their blocks) dealt here."""

    def crowds_of(t: pa.Table) -> pa.Table:
        keys = list(zip(*(t.column(c).to_pylist() for c in ("hub", "i", "j"))))
        found = []
        by: dict[tuple, list[int]] = {}
        for row, key in enumerate(keys):
            by.setdefault(key, []).append(row)
        for rows in by.values():
            sets = _sets(t.take(rows), shared)
            cls = sorted(sets)
            if len(cls) > 1:
                found += [(cls[x], cls[y]) for x, y in reach([sets[c] for c in cls])]
        cols = list(zip(*found)) or [[], []]
        return pa.table({"a": pa.array(cols[0], pa.int64()), "b": pa.array(cols[1], pa.int64())})

    return crowds_of


def with_texts(wanted: DataFrame, classes: DataFrame, docs: DataFrame, name: str) -> tuple[DataFrame, int]:
    """Rows (cls, ...) with the text of each class, and how many.  Texts are picked where they
    are read; only picked ones are shuffled."""
    wanted = staged(wanted.join(classes.select("cls", F.col("rep").alias("_rep")), "cls"), name)
    return docs.join(small(wanted), docs["doc_id"] == F.col("_rep")).drop("_rep", "doc_id"), wanted.count()


def verify(pairs: DataFrame, classes: DataFrame, docs: DataFrame, shared: frozenset[int], name: str) -> DataFrame:
    """Exact answers for staged ``pairs`` (spoke, hub).  A hub with many spokes is
    dealt to several places."""
    fans = pairs.groupBy("hub").agg(F.ceil(F.count(F.lit(1)) / SPOKES).alias("fans"))
    rows = pairs.join(fans, "hub").withColumn("fan", F.pmod(F.xxhash64("spoke"), F.col("fans")))
    hubs = fans.select("hub", F.explode(F.sequence(F.lit(0).cast("long"), F.col("fans") - 1)).alias("fan"))
    wanted = rows.select("hub", "fan", F.col("spoke").alias("cls")).unionByName(hubs.select("hub", "fan", F.col("hub").alias("cls")))
    rows, n = with_texts(wanted, classes, docs, name)
    place = F.pmod(F.xxhash64("hub", "fan"), F.lit(max(1, n // (2 * SPOKES))))
    return staged(rows.groupBy(place.alias("place")).applyInArrow(_compare(shared), VERIFIED), name)


def crowds(members: DataFrame) -> DataFrame:
    """(cls, hub) of the classes in staged long lists (list, cls, ...)."""
    often = members.groupBy("cls").agg(F.count(F.lit(1)).alias("k"))
    elected = members.join(often, "cls").groupBy("list").agg(F.max(F.struct("k", "cls")).alias("e")).select("list", F.col("e.cls").alias("hub"))
    # a list may hold a third of all classes: its members are dealt to many places, its hub is sent to each
    elected = elected.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(LIST_SALTS - 1))))
    salted = members.withColumn("salt", F.pmod(F.xxhash64("cls"), F.lit(LIST_SALTS)).cast("int"))
    votes = salted.join(elected, ["list", "salt"]).groupBy("cls", "hub").agg(F.count(F.lit(1)).alias("k"))
    return votes.groupBy("cls").agg(F.max(F.struct("k", "hub")).alias("v")).select("cls", F.col("v.hub").alias("hub"))


def crowd_links(crowd: DataFrame, classes: DataFrame, docs: DataFrame, shared: frozenset[int]) -> DataFrame:
    """Links within crowds (a, b).  A crowd of one block is searched in one place.
    Of a larger one every member is compared with the hub; those that don't link
    to it (far) are searched in blocks, against each other and against members
    that are not too near the hub to reach them."""
    sizes = staged(crowd.groupBy("hub").agg(F.count(F.lit(1)).alias("size")).where("size > 1"), "crowd-sizes")
    rows = crowd.join(sizes.where(F.col("size") <= CROWD_BLOCK), "hub").select("cls", "hub", F.lit(0).alias("i"), F.lit(0).alias("j"))
    large, links = sizes.where(F.col("size") > CROWD_BLOCK), None
    if not large.isEmpty():
        asked = crowd.join(large, "hub").where("cls <> hub").select(F.col("cls").alias("spoke"), "hub")
        met = verify(staged(asked, "crowd-members"), classes, docs, shared, "crowd-hubs")
        ok = similar(F.col("inter"), F.col("na"), F.col("nb"))
        links = met.where(ok).select("a", "b")
        apart = 1 - F.col("inter") / (F.col("na") + F.col("nb") - F.col("inter"))
        met = met.select(F.col("a").alias("cls"), F.col("b").alias("hub"), (~ok).alias("far"), apart.alias("apart"))
        limit = 1 - NUM / DEN + 1e-9  # of the distance of linked sets, rounding allowed for
        nearest = met.where("far").groupBy("hub").agg(F.min("apart").alias("least"))
        left = staged(met.join(nearest, "hub").where(F.col("far") | (F.col("apart") + limit >= F.col("least"))).select("cls", "hub", "far"), "crowd-rest")
        blocks = lambda far: F.ceil(F.count_if(F.col("far") == far) / CROWD_BLOCK).cast("int")
        parts = left.groupBy("hub").agg(blocks(True).alias("m"), blocks(False).alias("k"))
        far, m, k = F.col("far"), F.col("m"), F.col("k")
        place = lambda n: F.pmod(F.xxhash64("cls"), F.greatest(n, F.lit(1))).cast("int")
        left = left.join(parts, "hub").withColumn("x", F.when(far, place(m)).otherwise(m + place(k)))
        left = left.withColumn("y", F.explode(F.sequence(F.lit(0), F.when(far, m + k).otherwise(m) - 1)))
        left = left.where("x <> y OR m + k = 1")  # with several blocks, a block alone is part of its pairs
        rows = rows.unionByName(left.select("cls", "hub", F.least("x", "y").alias("i"), F.greatest("x", "y").alias("j")))
    rows, n = with_texts(rows, classes, docs, "crowds")
    place = F.pmod(F.xxhash64("hub", "i", "j"), F.lit(max(1, n // (2 * SPOKES))))
    found = staged(rows.groupBy(place.alias("place")).applyInArrow(_crowds(shared), "a long, b long"), "crowd-links")
    return found if links is None else found.unionByName(links)


def _within(t: pa.Table) -> pa.Table:
    """Pairs of long lists whose ends are in different crowds and components."""
    left, right = [], []
    lists = t.column("list").to_numpy()
    order = np.argsort(lists, kind="stable")
    lists = lists[order]
    cls, n, place, label, hub = (t.column(c).to_numpy()[order] for c in ("cls", "n", "place", "label", "hub"))
    ends = np.flatnonzero(np.concatenate(([True], lists[1:] != lists[:-1], [True])))
    for s, e in zip(ends[:-1].tolist(), ends[1:].tolist()):
        if (hub[s:e] == hub[s]).all() or (label[s:e] == label[s]).all():
            continue
        by = s + np.lexsort((cls[s:e], n[s:e]))
        for i, j in block_pairs(n[by], place[by]):
            i, j = by[i], by[j]
            apart = (label[i] != label[j]) & (hub[i] != hub[j])
            left.append(np.minimum(cls[i[apart]], cls[j[apart]]))
            right.append(np.maximum(cls[i[apart]], cls[j[apart]]))
    a, b = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (left, right))
    return pa.table({"a": pa.array(a), "b": pa.array(b)})


def sets_and_classes(docs: DataFrame, buckets: int) -> tuple[DataFrame, DataFrame, DataFrame, frozenset[int]]:
    """Rows (doc_id, n, cls), classes (cls, rep), the commonest prefix shingles, and
    first halves of fingerprints that different sets share."""
    scanned = staged(docs.mapInArrow(_scan(buckets), SCAN), "sets")
    rows = scanned.where("kind = 0").select("doc_id", "n", "cls", "check")

    def classes_of(rows: DataFrame) -> DataFrame:
        sound = rows.where("n > 0 AND doc_id IS NOT NULL")
        return staged(sound.groupBy("cls").agg(F.min("doc_id").alias("rep"), F.min("check").alias("lo"), F.max("check").alias("hi")), "classes")

    classes = classes_of(rows)
    shared = frozenset(r[0] for r in classes.where("lo <> hi").select("cls").collect())  # of n sets about n * n / 2**65
    if shared:
        of = F.col("cls").isin(*shared)
        rows = rows.select("doc_id", "n", F.when(of, F.col("check")).otherwise(F.col("cls")).alias("cls"), F.when(of, F.col("cls")).otherwise(F.col("check")).alias("check"))
        classes = classes_of(rows)
        if not classes.where("lo <> hi").isEmpty():
            raise ValueError("two different sets share either half of their fingerprints; choose other constants in fingerprint()")
    common = scanned.where("kind = 1").groupBy("bucket").applyInArrow(_count, "token long, sets long")
    common = common.orderBy(F.desc("sets"), "token").limit(COMMON_KEPT)
    return rows.drop("check"), classes.select("cls", "rep"), common, shared


def jaccard_components(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, component_id."""
    docs = small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    buckets = min(1 << 16, parts_for(docs, "text"))
    rows, classes, common, shared = sets_and_classes(docs, buckets)
    late = np.sort(np.array([r[0] for r in common.select("token").collect()], np.int64))  # at most COMMON_KEPT
    lists = docs.where("doc_id IS NOT NULL").mapInArrow(_index(buckets, late, shared), INDEX)
    found = staged(lists.groupBy("bucket").applyInArrow(_lists, FOUND), "found")
    pairs = staged(found.where("a IS NOT NULL").groupBy("a", "b").agg(F.sum("shared").alias("shared")), "pairs")

    members = found.where("members IS NOT NULL").select(F.monotonically_increasing_id().alias("list"), "members", "places", "sizes")
    members = staged(members.mapInArrow(_explode, "list long, cls long, place long, n long"), "members")
    crowd = staged(crowds(members), "crowd")
    in_crowds = crowd_links(crowd, classes, docs, shared)

    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"), "shared"))
    best = both.groupBy("a").agg(F.max(F.struct("shared", F.col("b").alias("hub"))).alias("m")).select(F.col("a").alias("spoke"), F.col("m.hub").alias("hub"))
    best = best.join(crowd.select(F.col("cls").alias("spoke")), "spoke", "left_anti")
    once = ~((F.col("spoke") > F.col("hub")) & F.col("mutual").isNotNull())  # of two that chose each other, one
    best = best.join(best.select(F.col("hub").alias("spoke"), F.col("spoke").alias("hub"), F.lit(1).alias("mutual")), ["spoke", "hub"], "left").where(once).drop("mutual")
    first = verify(staged(best, "best"), classes, docs, shared, "first")
    ok = similar(F.col("inter"), F.col("na"), F.col("nb"))
    links = first.where(ok).select("a", "b").unionByName(in_crowds)
    label = staged(components(links).select(F.col("node").alias("cls"), F.col("component").alias("label")), "label")

    n_lists = max(1, found.where("members IS NOT NULL").count() // 16)
    lists = members.join(crowd, "cls").join(label, "cls", "left").withColumn("label", F.coalesce("label", "cls"))
    crossing = lists.groupBy(F.pmod("list", F.lit(n_lists)).alias("place_")).applyInArrow(_within, "a long, b long")
    side = lambda c: label.select(F.col("cls").alias(c), F.col("label").alias(f"label_{c}"))
    rest = pairs.select("a", "b").unionByName(crossing).distinct().join(side("a"), "a", "left").join(side("b"), "b", "left")
    rest = rest.where(F.coalesce("label_a", "a") != F.coalesce("label_b", "b")).select("a", "b")
    known = first.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    rest = staged(rest.join(known, ["a", "b"], "left_anti"), "rest")
    degree = rest.select(F.explode(F.array("a", "b")).alias("x")).groupBy("x").count()
    deg = lambda c: degree.select(F.col("x").alias(c), F.col("count").alias(f"n_{c}"))
    a_hub = F.col("n_a") > F.col("n_b")
    turned = rest.join(deg("a"), "a").join(deg("b"), "b").select(F.when(a_hub, F.col("b")).otherwise(F.col("a")).alias("spoke"), F.when(a_hub, F.col("a")).otherwise(F.col("b")).alias("hub"))
    second = verify(staged(turned, "turned"), classes, docs, shared, "second")

    links = links.unionByName(second.where(ok).select("a", "b"))
    rep = lambda c: classes.select(F.col("cls").alias(c), F.col("rep").alias(f"rep_{c}"))
    links = links.join(rep("a"), "a").join(rep("b"), "b").select(F.col("rep_a").alias("a"), F.col("rep_b").alias("b"))
    groups = components(links)
    of_class = staged(classes.join(groups, F.col("rep") == F.col("node"), "left").select("cls", F.coalesce("component", "rep").alias("component")), "components")
    linked = (F.col("n") > 0) & F.col("doc_id").isNotNull()
    return rows.join(of_class, "cls", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(linked, F.col("component")).otherwise(F.col("doc_id")).alias("component_id")
    )


def _explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for i in range(b.num_rows):
            cls = np.frombuffer(b.column(1)[i].as_py(), np.int64)
            place, n = (np.frombuffer(b.column(c)[i].as_py(), np.uint32).astype(np.int64) for c in (2, 3))
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (np.full(len(cls), b.column(0)[i].as_py(), np.int64), cls, place, n)], names=["list", "cls", "place", "n"])


def near_dedup(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each component: the smallest doc_id's.  Rows with
    a null doc_id stay."""
    groups = jaccard_components(docs)
    drop = staged(groups.where("component_id <> doc_id").select(F.col("doc_id").alias("_id")).distinct(), "drop")
    return docs.join(small(drop), docs["doc_id"].cast("long") == F.col("_id"), "left_anti")
