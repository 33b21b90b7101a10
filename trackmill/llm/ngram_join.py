"""Exact Jaccard self-join of word-shingle sets by universe partition and pigeonhole.

Sets are joined in size bands. In a band two linked sets differ in at most ``delta`` shingles. A hash
deals all possible shingles to more than ``delta`` segments, so linked sets agree on a segment. A
signature is the content of one segment of one set:

* A set with more than ``delta`` segments that are not empty indexes the contents of those. If more
  than ``delta`` of them occur in no other set, nothing is linked with it, and probing costs nothing:
  that is how segments are allocated, by the length of their lists.
* A set with fewer such segments also indexes their one-deletion neighbourhoods, which count double
  as they allow a difference; and single shingles where even that is not enough. Pairs of a
  scarce and another set are found by the other one's segments.

Sets left after this are the ones with near relatives, and they are many to a list in a group of
copies. Instead of all pairs of a list, each set is verified against the list's best connected
set, its hub. Two sets that agree with the hub are connected. If one does not, two linked sets must
share a shingle that the list's centre lacks, or lie so near the centre that sizes tell (see
``_by_sizes``); so sets of different components that share such a shingle are the next, smaller
lists. This ends as lists shrink, and no link between two components is lost.

Copies (equal sets) are one set throughout. Defined results: a text without words, empty or null is
linked with nothing and is its own component; a null doc_id takes no part in links and keeps a null
component; rows that repeat a doc_id are texts of one node, whose links and smallest ids they share;
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from trackmill.llm.common import batch, merged, pack, partitions, slices, stored, table, unpack, utf8
from trackmill.llm.components import components
from trackmill.llm.shingles import ShingleSets, mix

#: Lists of so many sets are verified pair by pair.
SMALL = 16

#: Signatures, or shingles, that a task gathers before it deals them to buckets: a row for each bucket
#: and slice of texts would be a number that grows with the square of the input.
GATHERED = 1 << 19

#: 100 * intersection >= 80 * union, and what follows from it.
LINK, OF = 80, 100


def _tops() -> np.ndarray:
    """Largest size of each band: linked sizes lie in one band or in neighbours."""
    tops = [4]
    while tops[-1] < 1 << 40:
        tops.append(max(tops[-1] + 1, -(-tops[-1] * OF // LINK)))
    return np.array(tops, dtype=np.int64)


TOPS = _tops()


def delta_of(top: np.ndarray) -> np.ndarray:
    """Most shingles in which two linked sets of at most ``top`` shingles differ."""
    return 2 * top * (OF - LINK) // (OF + LINK)


class Signatures:
    """Signatures of all sets of a batch: hash, owner (place in the batch), side (0: the set's
    own band, 1: the next one); and ``need``: how many shared signatures make a set a candidate."""

    def __init__(self, sets: ShingleSets):
        self.need = np.ones((len(sets.size), 2), dtype=np.int64)
        found = [self._of_side(sets, side) for side in (0, 1)]
        self.hash, self.owner, self.side = (np.concatenate([f[i] for f in found]) for i in range(3))

    def _of_side(self, sets: ShingleSets, side: int):
        band = np.searchsorted(TOPS, sets.size) + side
        takes = sets.size > 0
        if side:  # only sets that a larger one of the next band can be linked with
            takes &= sets.size * OF // LINK > TOPS[band - 1]
        delta = delta_of(TOPS[band])
        segments = delta + 2 + -(-delta * 15 // 100)
        chosen = takes[sets.owner]
        owner, token = sets.owner[chosen], sets.hashes[chosen]
        seed = mix(band.astype(np.uint64))
        segment = (mix(token ^ seed[owner]) >> np.uint64(16)) % segments[owner].astype(np.uint64)
        spread = mix(token + seed[owner])
        order = np.lexsort((segment, owner))
        owner, segment, spread, token = owner[order], segment[order], spread[order], token[order]
        new = np.ones(len(owner), dtype=bool)
        new[1:] = (owner[1:] != owner[:-1]) | (segment[1:] != segment[:-1])
        first = np.flatnonzero(new)
        if not len(first):
            return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        total = np.add.reduceat(spread, first)
        size = np.diff(np.append(first, len(owner)))
        whose, place = owner[first], mix(segment[first] + seed[owner[first]])
        full = np.bincount(whose, minlength=len(sets.size))
        scarce = takes & (full <= delta)
        self.need[takes, side] = np.where(scarce, 1, full - delta)[takes]
        parts = [(mix(total + place), whose)]
        if scarce.any():
            # one-deletion neighbourhoods: the content, and the content without each shingle
            kind = np.uint64(0xD1E7E)
            here = scarce[whose]
            parts.append((mix(total[here] + place[here] + kind), whose[here]))
            of = np.repeat(np.arange(len(first)), size)
            single = here[of] & (size[of] > 1)
            parts.append((mix(total[of[single]] - spread[single] + place[of[single]] + kind), owner[single]))
            double = np.bincount(whose, weights=np.minimum(size, 2), minlength=len(sets.size))
            rest = (scarce & (double <= delta))[owner]
            parts.append((mix(token[rest] + seed[owner[rest]] + np.uint64(0x70CE2)), owner[rest]))
        hashes, owners = (np.concatenate([p[i] for p in parts]) for i in range(2))
        return hashes, owners, np.full(len(owners), side)


# --- which sets have candidates at all ---------------------------------------------------------

SETS = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("low", pa.int64()), ("high", pa.int64())])
LISTS = pa.schema(
    [("bucket", pa.int64()), ("sets", pa.binary()), ("needs", pa.binary()), ("owners", pa.binary()), ("hashes", pa.binary())]
)
COUNTS = pa.schema([("home", pa.int64()), ("counts", pa.binary())])
ACTIVE = pa.schema([("low", pa.int64()), ("degree", pa.int64())])
COUNT = np.dtype([("set", "<u8"), ("side", "<i4"), ("need", "<i4"), ("shared", "<i4"), ("weight", "<i8")])


def sql(schema: pa.Schema) -> str:
    names = {pa.int64(): "long", pa.binary(): "binary", pa.bool_(): "boolean"}
    return ", ".join(f"{f.name} {names.get(f.type, 'array<long>')}" for f in schema)


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows in slices(batches):
        sets = ShingleSets(list(utf8(rows["text"])))
        yield batch(
            SETS,
            doc_id=rows["doc_id"].cast(pa.int64()),
            n_shingles=sets.size,
            low=sets.sums(1).view(np.int64),
            high=sets.sums(2).view(np.int64),
        )


def _dealt(keys: np.ndarray, buckets: int) -> Iterator[tuple[int, np.ndarray]]:
    bucket = (keys >> np.uint64(17)) % np.uint64(buckets)
    order = np.argsort(bucket, kind="stable")
    at = np.searchsorted(bucket[order], np.arange(buckets + 1).astype(np.uint64))
    for k in range(buckets):
        if at[k] < at[k + 1]:
            yield k, order[at[k] : at[k + 1]]


def _gathered(parts: Iterator[tuple[np.ndarray, ...]]) -> Iterator[tuple[np.ndarray, ...]]:
    """The same arrays put together, until the first has GATHERED entries. The second is of owners, which
    are places in the arrays from the fourth on; the third tells sides."""
    held, entries, owners = [], 0, 0
    for hashes, owner, side, *of_owners in parts:
        held.append((hashes, owner + owners, side, *of_owners))
        entries, owners = entries + len(hashes), owners + len(of_owners[0])
        if entries >= GATHERED:
            yield tuple(np.concatenate(x) for x in zip(*held))
            held, entries, owners = [], 0, 0
    if held:
        yield tuple(np.concatenate(x) for x in zip(*held))


def _send_lists(buckets: int):
    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, ...]]:
        seen = np.zeros(0, dtype=np.uint64)
        for rows in slices(batches):
            sets = ShingleSets(list(utf8(rows["text"])))
            names = sets.sums(1)
            signatures = Signatures(sets)
            # equal sets of a task are sent once
            once = np.zeros(len(names), dtype=bool)
            once[np.unique(names, return_index=True)[1]] = True
            once &= ~np.isin(names, seen)
            seen = np.union1d(seen, names)
            use = once[signatures.owner]
            need = np.minimum(signatures.need, 1 << 30).astype(np.int32)
            yield signatures.hash[use], signatures.owner[use], signatures.side[use].astype(np.int8), names, need

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for hashes, owner, side, names, need in _gathered(found(batches)):
            out = {name: [] for name in LISTS.names}
            for bucket, part in _dealt(hashes, buckets):
                part = part[np.argsort(owner[part], kind="stable")]
                there, place = np.unique(owner[part], return_inverse=True)
                out["bucket"].append(bucket)
                out["sets"].append(pack(names[there]))
                out["needs"].append(pack(need[there], "<i4"))
                out["owners"].append(pack(2 * place + side[part], "<u4"))
                out["hashes"].append(pack(hashes[part]))
            yield batch(LISTS, **out)

    return send


def _count_shared(buckets: int):
    """In a bucket: for each set and side the signatures that another set has, and how many have."""

    def count(rows: pa.Table) -> pa.Table:
        names, sides, needs, hashes = [], [], [], []
        for row in rows.to_pylist():
            owner = unpack(row["owners"], "<u4")
            place, side = owner >> 1, (owner & 1).astype(np.int32)
            names.append(unpack(row["sets"])[place])
            needs.append(unpack(row["needs"], "<i4").reshape(-1, 2)[place, side])
            sides.append(side)
            hashes.append(unpack(row["hashes"]))
        h, name = np.concatenate(hashes), np.concatenate(names)
        order = np.lexsort((name, h))
        h, name = h[order], name[order]
        side, need = np.concatenate(sides)[order], np.concatenate(needs)[order]
        new = np.append(True, h[1:] != h[:-1])
        fresh = new | np.append(True, name[1:] != name[:-1])
        group = np.cumsum(new) - 1
        many = np.bincount(group, weights=fresh)[group]
        use = fresh & (many > 1)
        out = np.zeros(int(use.sum()), dtype=COUNT)
        out["set"], out["side"], out["need"] = name[use], side[use], need[use]
        out["shared"], out["weight"] = 1, many[use]
        out = _added(out)
        found = [{"home": k, "counts": out[part].tobytes()} for k, part in _dealt(out["set"].copy(), buckets)]
        return pa.Table.from_pylist(found, schema=COUNTS)

    return count


def _added(counts: np.ndarray) -> np.ndarray:
    """One entry for each set and side."""
    counts = counts[np.lexsort((counts["side"], counts["set"]))]
    if not len(counts):
        return counts
    first = np.flatnonzero(
        np.append(True, (counts["set"][1:] != counts["set"][:-1]) | (counts["side"][1:] != counts["side"][:-1]))
    )
    out = counts[first]
    out["shared"] = np.add.reduceat(counts["shared"], first)
    out["weight"] = np.add.reduceat(counts["weight"], first)
    return out


def _choose_active(rows: pa.Table) -> pa.Table:
    counts = np.concatenate([np.frombuffer(x, COUNT) for x in rows["counts"].to_pylist()])
    counts = _added(counts)
    counts = counts[counts["shared"] >= counts["need"]]
    names, which = np.unique(counts["set"], return_inverse=True)
    degree = np.bincount(which, weights=counts["weight"], minlength=len(names)).astype(np.int64)
    return pa.table({"low": names.view(np.int64), "degree": degree}, schema=ACTIVE)


# --- candidates, hubs and links ------------------------------------------------------------------

MEMBERS = pa.schema([("doc_id", pa.int64()), ("degree", pa.int64()), ("shingles", pa.binary())])
SPREAD = pa.schema([("bucket", pa.int64()), ("docs", pa.binary()), ("hashes", pa.binary())])
COUNTED = pa.schema([("home", pa.int64()), ("docs", pa.binary()), ("hashes", pa.binary()), ("counts", pa.binary())])
RANKED = pa.schema([*MEMBERS, ("counts", pa.binary())])
HOMES = pa.schema([("bucket", pa.int64()), ("docs", pa.binary()), ("degrees", pa.binary()), ("hashes", pa.binary())])
PAIRS = pa.schema([("doc_id", pa.int64()), ("hub", pa.int64())])
VERIFIED = pa.schema(
    [("g", pa.int64()), ("doc_id", pa.int64()), ("hub", pa.int64()), ("linked", pa.bool_()), ("added", pa.list_(pa.int64()))]
)
DESCRIBED = pa.schema(
    [
        ("g", pa.int64()),
        ("doc_id", pa.int64()),
        ("n", pa.int64()),
        ("n_added", pa.int64()),
        ("n_lost", pa.int64()),
        ("n_alone", pa.int64()),
        ("added", pa.list_(pa.int64())),
    ]
)


def _sets_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows in slices(batches):
        sets = ShingleSets(list(utf8(rows["text"])))
        yield batch(
            MEMBERS,
            doc_id=rows["doc_id"].cast(pa.int64()),
            degree=rows["degree"],
            shingles=[pack(sets.of(i)) for i in range(len(sets.size))],
        )


class _Given(ShingleSets):
    """Sets that are at hand."""

    def __init__(self, blobs: list[bytes]):
        parts = [unpack(b) for b in blobs]
        self.size = np.array([len(p) for p in parts], dtype=np.int64)
        self.hashes = np.concatenate([np.zeros(0, np.uint64), *parts])
        self.owner = np.repeat(np.arange(len(parts)), self.size)
        self.start = np.cumsum(self.size) - self.size


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, _Given]]:
    for rows in (b.slice(low, 1000) for b in batches for low in range(0, b.num_rows, 1000)):
        yield rows, _Given(rows["shingles"].to_pylist())


def _numbers(rows: pa.RecordBatch, name: str) -> np.ndarray:
    return np.array(rows[name].to_numpy(zero_copy_only=False))


def _spread(buckets: int):
    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, ...]]:
        for rows, sets in _members(batches):
            yield sets.hashes, sets.owner, np.zeros(len(sets.owner), np.int8), _numbers(rows, "doc_id")

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for hashes, owner, _, ids in _gathered(found(batches)):
            out = {name: [] for name in SPREAD.names}
            for bucket, part in _dealt(hashes, buckets):
                out["bucket"].append(bucket)
                out["docs"].append(pack(ids[owner[part]], "<i8"))
                out["hashes"].append(pack(hashes[part]))
            yield batch(SPREAD, **out)

    return send


def _count_sets(buckets: int):
    """In a bucket: how many sets have each shingle, up to 255, told to the sets."""

    def count(rows: pa.Table) -> pa.Table:
        docs = np.concatenate([unpack(x, "<i8") for x in rows["docs"].to_pylist()])
        h = np.concatenate([unpack(x) for x in rows["hashes"].to_pylist()])
        _, which, many = np.unique(h, return_inverse=True, return_counts=True)
        counts = np.minimum(many, 255).astype(np.uint8)[which]
        found = [
            {"home": k, "docs": pack(docs[part], "<i8"), "hashes": pack(h[part]), "counts": counts[part].tobytes()}
            for k, part in _dealt(mix(docs.view(np.uint64)), buckets)
        ]
        return pa.Table.from_pylist(found, schema=COUNTED)

    return count


def _rank_shingles(key, members: pa.Table, told: pa.Table) -> pa.Table:
    """The sets that can be linked at all, with the counts of their shingles.

    Linked sets share four fifths of each, so one of more than a fifth of shingles that nothing else
    has is linked with nothing.
    """
    if not (members.num_rows and told.num_rows):
        return RANKED.empty_table()
    docs, h, counts = (
        np.concatenate([unpack(x, kind) for x in told[name].to_pylist()])
        for name, kind in (("docs", "<i8"), ("hashes", "<u8"), ("counts", "u1"))
    )
    order = np.lexsort((h, docs))
    docs, h, counts = docs[order], h[order], counts[order]
    out = {name: [] for name in RANKED.names}
    for row in members.select(MEMBERS.names).to_pylist():
        low, high = np.searchsorted(docs, [row["doc_id"], row["doc_id"] + 1])
        own = counts[low:high][np.searchsorted(h[low:high], unpack(row["shingles"]))]
        if OF * (own == 1).sum() <= (OF - LINK) * len(own):
            for name in MEMBERS.names:
                out[name].append(row[name])
            out["counts"].append(own.tobytes())
    return pa.table(out, schema=RANKED)


def _ranked(members: DataFrame, buckets: int) -> DataFrame:
    told = (
        members.mapInArrow(_spread(buckets), sql(SPREAD))
        .groupBy("bucket")
        .applyInArrow(_count_sets(buckets), sql(COUNTED))
    )

    def homes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            ids = np.array(rows["doc_id"].to_numpy(zero_copy_only=False))
            home = (mix(ids.view(np.uint64)) >> np.uint64(17)) % np.uint64(buckets)
            yield rows.append_column("home", pa.array(home.astype(np.int64)))

    at_home = members.select(*MEMBERS.names).mapInArrow(homes, f"{sql(MEMBERS)}, home long")
    return stored(at_home.groupBy("home").cogroup(told.groupBy("home")).applyInArrow(_rank_shingles, sql(RANKED)))


def _send_members(buckets: int):
    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, ...]]:
        for rows, sets in _members(batches):
            signatures = Signatures(sets)
            yield signatures.hash, signatures.owner, signatures.side, _numbers(rows, "doc_id"), _numbers(rows, "degree")

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for hashes, owner, _, ids, degree in _gathered(found(batches)):
            out = {name: [] for name in HOMES.names}
            for bucket, part in _dealt(hashes, buckets):
                out["bucket"].append(bucket)
                out["docs"].append(pack(ids[owner[part]], "<i8"))
                out["degrees"].append(pack(degree[owner[part]], "<i8"))
                out["hashes"].append(pack(hashes[part]))
            yield batch(HOMES, **out)

    return send


def _pair_with_hubs(rows: pa.Table) -> pa.Table:
    """Each set of a list with the list's best connected set."""
    docs, degrees, h = (
        np.concatenate([unpack(x, kind) for x in rows[name].to_pylist()])
        for name, kind in (("docs", "<i8"), ("degrees", "<i8"), ("hashes", "<u8"))
    )
    order = np.lexsort((docs, -degrees, h))
    docs, h = docs[order], h[order]
    first = np.flatnonzero(np.append(True, h[1:] != h[:-1]))
    hub = np.repeat(docs[first], np.diff(np.append(first, len(h))))
    pairs = np.unique(np.stack([docs, hub], axis=1)[docs != hub], axis=0)
    return pa.table({"doc_id": pairs[:, 0], "hub": pairs[:, 1]}, schema=PAIRS)


def _lacking(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The shingles of ``a`` that ``b`` lacks; both ascend."""
    return a[b[np.minimum(np.searchsorted(b, a), len(b) - 1)] != a]


def _first_of(a: np.ndarray, counts: np.ndarray, lacking: np.ndarray) -> np.ndarray:
    """Linked sets lack at most a fifth of each other's shingles. So two of them that share any of
    those that a third set lacks share one of this many, in the order of counts and hashes; and
    none that only one set has."""
    own = counts[np.searchsorted(a, lacking)]
    order = np.lexsort((lacking, own))[: len(a) * (OF - LINK) // OF + 1]
    return lacking[order[own[order] > 1]].view(np.int64)


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whether a set is linked with a hub, and shingles that the hub lacks."""
    for rows in batches:
        linked, first = [], []
        for a, n, b in zip(*(rows[c].to_pylist() for c in ("shingles", "counts", "hub_shingles"))):
            a, b = unpack(a), unpack(b)
            added = _lacking(a, b)
            common = len(a) - len(added)
            linked.append(OF * common >= LINK * (len(a) + len(b) - common))
            first.append(_first_of(a, unpack(n, "u1"), added))
        yield batch(VERIFIED, g=rows["g"], doc_id=rows["doc_id"], hub=rows["hub"], linked=linked, added=first)


def _describe_from_centre(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How a set differs from its group's centre: the hub with the shingles that most sets add."""
    for rows in batches:
        found = []
        for a, n, b, common in zip(*(rows[c].to_pylist() for c in ("shingles", "counts", "hub_shingles", "common"))):
            a, b, n = unpack(a), unpack(b), unpack(n, "u1")
            centre = np.union1d(b, np.array(common or [], dtype=np.int64).view(np.uint64))
            added = _lacking(a, centre)
            found.append(
                (len(a), len(added), len(centre) - len(a) + len(added), int((n == 1).sum()), _first_of(a, n, added))
            )
        n, n_added, n_lost, n_alone, first = zip(*found) if found else ([], [], [], [], [])
        yield batch(
            DESCRIBED, g=rows["g"], doc_id=rows["doc_id"], n=n, n_added=n_added, n_lost=n_lost, n_alone=n_alone,
            added=list(first),
        )


def _by_sizes(described: DataFrame) -> DataFrame:
    """Pairs of a group that can be linked without sharing a shingle that its centre lacks.

    With a and b shingles added to and missing from the centre, such sets differ in at least
    a1 + a2 + |b1 - b2|, so both lie about as near the centre as linked sets do. Those are
    connected through the hubs but for a few at the border.
    """
    r = described.select("g", "doc_id", "n", "n_added", "n_lost", "component")
    r = r.filter(f"{OF + LINK} * n_added <= {OF - LINK} * (n + n * {OF} div {LINK})")
    # a group's largest component is not met with itself: pairs follow those of different components
    sizes = r.groupBy("g", "component").agg(F.count("*").alias("size"))
    largest = sizes.groupBy("g").agg(F.max(F.struct("size", "component"))["component"].alias("largest"))
    others = merged(r, largest, "g").filter("component <> largest")
    s = r.select(F.col("g").alias("g_2"), *[F.col(c).alias(f"{c}_2") for c in r.columns[1:]])
    close = f"{OF + LINK} * (n_added + n_added_2 + abs(n_lost - n_lost_2)) <= {OF - LINK} * (n + n_2)"
    pairs = merged(others, s, F.expr(f"g = g_2 and component <> component_2 and {close}"))
    low = F.expr("component < component_2")
    return pairs.select(
        F.when(low, F.col("doc_id")).otherwise(F.col("doc_id_2")).alias("doc_id"),
        F.when(low, F.col("doc_id_2")).otherwise(F.col("doc_id")).alias("hub"),
    ).distinct()


def _pairs_of_small(lists: DataFrame) -> DataFrame:
    """Pairs of different components in lists of at most SMALL sets, if sizes and the shingles that
    only one set has allow a link."""
    r = lists.select("g", "doc_id", "n", "n_alone", "component")
    s = r.select(F.col("g").alias("g_2"), *[F.col(c).alias(f"{c}_2") for c in r.columns[1:]])
    able = f"{OF + LINK} * greatest(n_alone + n_alone_2, abs(n - n_2)) <= {OF - LINK} * (n + n_2)"
    pairs = merged(r, s, F.expr(f"g = g_2 and component < component_2 and {able}"))
    return pairs.select("doc_id", F.col("doc_id_2").alias("hub")).distinct()


def _links(members: DataFrame, buckets: int) -> DataFrame:
    """a, b: verified links that connect every component of the sets in ``members``.

    A group is a list of sets with a hub. Round by round: verify the sets against the hub, and
    against the set nearest the group's centre; then, only where a group holds several components,
    verify the pairs that sizes leave open, and make groups of the sets that share a shingle the
    centre lacks.
    """
    sets = members.select("doc_id", "shingles", "counts")
    hubs = members.select(F.col("doc_id").alias("hub"), F.col("shingles").alias("hub_shingles"))
    degrees = members.select("doc_id", "degree")

    def with_sets(rows: DataFrame) -> DataFrame:
        return merged(merged(rows, hubs, "hub"), sets, "doc_id")

    def verified(rows: DataFrame) -> DataFrame:
        rows = with_sets(rows.filter("doc_id <> hub")).select("g", "doc_id", "hub", "shingles", "counts", "hub_shingles")
        return stored(rows.mapInArrow(_verify, sql(VERIFIED)))

    def linked(rows: DataFrame) -> DataFrame:
        return rows.filter("linked").select(F.col("doc_id").alias("a"), F.col("hub").alias("b"))

    pairs = (
        members.mapInArrow(_send_members(buckets), sql(HOMES))
        .groupBy("bucket")
        .applyInArrow(_pair_with_hubs, sql(PAIRS))
        .distinct()
    )
    rows = pairs.select(F.col("hub").alias("g"), "doc_id", "hub")
    links, found, unseen = members.select(F.col("doc_id").alias("a"), F.col("doc_id").alias("b")).limit(0), None, 0
    while True:
        met = verified(rows)
        links, unseen = links.unionAll(linked(met)), unseen + linked(met).count()
        # groups of three sets or more that the hub does not settle
        groups = (
            met.groupBy("g", "hub")
            .agg(F.count("*").alias("many"), F.bool_and("linked").alias("settled"))
            .filter("many > 1 and not settled")
            .select("g", "hub", "many")
        )
        usual = met.select("g", F.explode("added").alias("token")).groupBy("g", "token").count()
        usual = merged(usual, groups, "g").filter("2 * count > many").groupBy("g").agg(F.collect_list("token").alias("common"))
        inside = met.select("g", "doc_id").unionAll(groups.select("g", F.col("hub").alias("doc_id")))
        inside = with_sets(merged(inside, merged(groups.select("g", "hub"), usual, "g", "left"), "g"))
        described = stored(
            inside.select("g", "doc_id", "shingles", "counts", "hub_shingles", "common").mapInArrow(_describe_from_centre, sql(DESCRIBED))
        )
        if described.isEmpty():
            return links
        nearest = described.groupBy("g").agg(F.min(F.struct(F.expr("n_added + n_lost"), "doc_id")).alias("best"))
        nearest = nearest.select("g", F.col("best.doc_id").alias("hub"))
        again = merged(described.select("g", "doc_id"), nearest, "g").select("doc_id", "hub").distinct()
        again = merged(again, met.select("doc_id", "hub"), ["doc_id", "hub"], "left_anti")
        new = linked(verified(again.select(F.lit(0).cast("long").alias("g"), "doc_id", "hub")))
        links, unseen = links.unionAll(new), unseen + new.count()
        if found is None or unseen:  # else the components are those of the last round
            found, unseen = components(links), 0
        described = merged(described, found.withColumnRenamed("node", "doc_id"), "doc_id", "left")
        described = described.withColumn("component", F.coalesce("component", "doc_id"))
        mixed = described.groupBy("g").agg(F.min("component").alias("low"), F.max("component").alias("high"))
        described = stored(merged(described, mixed.filter("low <> high").select("g"), "g", "left_semi"))
        close = _by_sizes(described)
        new = linked(verified(close.select(F.lit(0).cast("long").alias("g"), "doc_id", "hub")))
        links, unseen = links.unionAll(new), unseen + new.count()
        lists = described.select("*", F.explode("added").alias("token")).drop("added")
        lists = lists.withColumn("g", F.xxhash64("g", "token"))
        best = (
            merged(lists, degrees, "doc_id")
            .groupBy("g")
            .agg(
                F.count("*").alias("many"),
                F.max(F.struct("degree", F.negate("doc_id").alias("last"))).alias("best"),
                F.min("component").alias("low"),
                F.max("component").alias("high"),
                F.sum(F.xxhash64("doc_id").cast("decimal(38,0)")).alias("members"),
            )
            .filter("low <> high")
            .select("g", "members", "many", F.expr("-best.last").alias("hub"))
            # lists of the same sets are one group
            .groupBy("members", "hub", "many")
            .agg(F.min("g").alias("g"))
            .select("g", "hub", "many")
        )
        found_lists = stored(merged(lists.select("g", "doc_id", "n", "n_alone", "component"), best, "g"))
        few = _pairs_of_small(found_lists.filter(F.col("many") <= SMALL))
        new = linked(verified(few.select(F.lit(0).cast("long").alias("g"), "doc_id", "hub")))
        links, unseen = links.unionAll(new), unseen + new.count()
        rows = found_lists.filter(F.col("many") > SMALL).select("g", "doc_id", "hub")


def join_similar(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id of every row."""
    buckets = partitions(docs.sparkSession)
    texts = docs.select("doc_id", "text")
    sets = stored(texts.mapInArrow(_describe, sql(SETS)))
    # equal sets: the smallest id stands for all
    classes = (
        sets.filter("n_shingles > 0 and doc_id is not null")
        .groupBy("low", "high")
        .agg(F.min("doc_id").alias("rep"))
    )
    active = (
        texts.filter("doc_id is not null")
        .mapInArrow(_send_lists(buckets), sql(LISTS))
        .groupBy("bucket")
        .applyInArrow(_count_shared(buckets), sql(COUNTS))
        .groupBy("home")
        .applyInArrow(_choose_active, sql(ACTIVE))
    )
    chosen = merged(classes, active, "low").groupBy("rep").agg(F.max("degree").alias("degree"))
    members = merged(texts, chosen, F.col("doc_id") == F.col("rep")).select("doc_id", "degree", "text")
    members = stored(members.mapInArrow(_sets_of, sql(MEMBERS)))
    members = _ranked(_ranked(members, buckets), buckets)  # what went makes other shingles unique
    same = merged(sets, classes, ["low", "high"]).select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    edges = _links(members, buckets).unionAll(same.filter("a <> b"))
    found = components(edges)
    return (
        merged(sets, found, sets["doc_id"] == found["node"], "left")
        .select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
    )


def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join_similar(table(spark, sf_dir, "documents"))
