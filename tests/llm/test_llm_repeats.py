"""Suffix removal, near-duplicate join and line dedup against plain versions."""

import hashlib
import random

import numpy as np
import plain
import pyarrow as pa
import pytest

from trackmill.llm import components as components_module, line_dedup, ngram_join, suffix
from trackmill.llm.components import components
from trackmill.llm.deep_shallow import BlindTrie, sort_suffixes


def removed(rows, length=50):
    first = {}
    big = 1 << 62
    ordered = sorted(((big if i is None else i), (t or "").encode()) for i, t in rows)
    for i, b in ordered:
        for p in range(len(b) - length + 1):
            first.setdefault(b[p : p + length], i)
    out = []
    for i, b in ordered:
        gone = np.zeros(len(b), bool)
        for p in range(len(b) - length + 1):
            if first[b[p : p + length]] < i:
                gone[p : p + length] = True
        spans = int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum())
        kept = bytes(np.frombuffer(b, np.uint8)[~gone])
        out.append((None if i == big else i, len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def test_suffix_removal_is_exact(spark):
    docs, rows = plain.documents(spark)
    found = suffix.remove_repeats(docs, digest=True).collect()
    assert sorted(map(str, removed(rows))) == sorted(
        str((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept).hex())) for r in found
    )


def test_suffix_removal_returns_the_bytes(spark):
    docs, _ = plain.documents(spark, [(1, "é" * 60), (2, "ab" + "é" * 30), (3, None)])
    found = {r.doc_id: bytes(r.kept).decode() for r in suffix.remove_repeats(docs).collect()}
    assert found == {1: "é" * 60, 2: "ab", 3: ""}
    assert suffix.remove_repeats(plain.empty(spark)).count() == 0


def test_what_suffix_removal_moves_is_compressed():
    rng = random.Random(3)
    words = [f"word{rng.randrange(10**4)}" for _ in range(300)]
    texts = [" ".join(rng.choice(words) for _ in range(200)) for _ in range(100)]
    ids = [None, *range(1, 100)]
    rows = pa.RecordBatch.from_pydict({"batch": [5] * 100, "doc_id": pa.array(ids, pa.int64()), "text": texts})
    packed = pa.Table.from_batches(list(suffix._send_texts(iter([rows]))))
    raw = "".join(texts).encode()
    assert suffix._texts_of(packed).bytes.tobytes() == raw
    assert sum(map(len, packed["texts"].to_pylist())) < 0.6 * len(raw)
    h = np.unique(suffix._texts_of(packed).hashes)
    assert suffix._unpack_48(suffix._pack_48(h)).tolist() == h.tolist()
    told = pa.table({"batch": [5], "hashes": [suffix._pack_48(h)]})
    sent = suffix._send_surroundings(4)([pa.scalar(5)], packed, told)
    records = sum(len(suffix._unsqueezed(x)) for x in sent["records"].to_pylist())
    assert records > len(raw) and sum(map(len, sent["records"].to_pylist())) < 0.6 * records


def test_suffixes_sort_like_their_bytes():
    rng = np.random.default_rng(0)
    text = rng.integers(97, 99, 3000).astype(np.uint8)
    text[1000:1400] = text[200:600]
    text[1440] ^= 1
    text[2000:2400] = text[200:600]
    text[2045::50] ^= 1
    starts = rng.permutation(2900)
    order, new = sort_suffixes(text, starts, 50)
    strings = [text[s : s + 50].tobytes() for s in starts[order]]
    assert strings == sorted(strings)
    assert list(new) == [True] + [a != b for a, b in zip(strings[1:], strings)]


def test_blind_trie_orders_strings():
    rng = random.Random(1)
    strings = [bytes(rng.choice(b"ab\x00") for _ in range(12)) for _ in range(500)]
    trie = BlindTrie()
    for i, s in enumerate(strings):
        trie.insert(s, i)
    groups = trie.in_order()
    assert [strings[g[0]] for g in groups] == sorted(set(strings))
    assert sorted(i for g in groups for i in g) == list(range(500))
    assert BlindTrie().in_order() == []


def groups_of(rows):
    sets = [(i, plain.shingles(t)) for i, t in rows]
    parent = {i: i for i, _ in sets if i is not None}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if a and b and None not in (i, j) and 100 * len(a & b) >= 80 * len(a | b):
                x, y = sorted((root(i), root(j)))
                parent[y] = x
    return sorted(str((i, len(a), i if i is None else root(i))) for i, a in sets)


def test_similarity_groups_are_exact(spark):
    docs, rows = plain.documents(spark)
    found = ngram_join.join_similar(docs).collect()
    assert sorted(str(tuple(r)) for r in found) == groups_of(rows)


@pytest.mark.parametrize("seed", [1, 2])
def test_groups_of_chains_and_border_cases(spark, seed):
    """Edits upon edits, of many sizes: copies linked through each other and not through a hub."""
    rng = random.Random(seed)
    rows = []
    for size in (1, 3, 5, 6, 8, 9, 10, 13, 20, 40, 150):
        text = [f"{size}a{rng.randrange(10**6)}" for _ in range(size)]
        for _ in range(14):
            rows.append((rng.randrange(10**9), " ".join(text)))
            source = rng.choice(rows[-3:])[1].split()
            for _ in range(rng.randrange(0, 3)):
                at = rng.randrange(len(source) + 1)
                change = rng.random()
                if change < 0.3:
                    source.insert(at, f"n{rng.randrange(10**6)}")
                elif change < 0.6 and len(source) > 1:
                    source.pop(min(at, len(source) - 1))
                elif at < len(source):
                    source[at] = f"n{rng.randrange(10**6)}"
            text = source
    docs, rows = plain.documents(spark, rows)
    found = ngram_join.join_similar(docs).collect()
    assert sorted(str(tuple(r)) for r in found) == groups_of(rows)


def test_similarity_join_gathers_nothing_on_the_driver(spark, monkeypatch):
    """Exploded lists and compressed files look small to Spark, which would broadcast them."""
    plans = []

    def told(module):
        stored = module.stored
        monkeypatch.setattr(module, "stored", lambda df: plans.append(df._jdf.queryExecution().sparkPlan().toString()) or stored(df))

    told(ngram_join), told(components_module)
    text = [f"w{i}" for i in range(40)]
    rows = [(i, " ".join([*text[: 30 + i % 10], *(f"x{i}{j}" for j in range(i % 12))])) for i in range(40)]
    docs, rows = plain.documents(spark, rows)
    found = ngram_join.join_similar(docs)
    plans.append(found._jdf.queryExecution().sparkPlan().toString())
    assert sorted(str(tuple(r)) for r in found.collect()) == groups_of(rows)
    assert len(plans) > 8 and [p for p in plans if "Broadcast" in p] == []


def test_signatures_of_many_slices_go_to_a_bucket_together():
    texts = pa.array([" ".join(f"w{i}x{j}" for j in range(20)) for i in range(200)])
    slices = [pa.RecordBatch.from_pydict({"text": texts[low : low + 5]}) for low in range(0, 200, 5)]
    sent = pa.Table.from_batches(list(ngram_join._send_lists(8)(iter(slices)))).to_pylist()
    whole = pa.RecordBatch.from_pydict({"text": texts})
    once = pa.Table.from_batches(list(ngram_join._send_lists(8)(iter([whole])))).to_pylist()

    def owned(rows):
        found = set()
        for row in rows:
            names, needs = np.frombuffer(row["sets"], "<u8"), np.frombuffer(row["needs"], "<i4").reshape(-1, 2)
            for owner, h in zip(np.frombuffer(row["owners"], "<u4"), np.frombuffer(row["hashes"], "<u8")):
                found.add((row["bucket"], int(names[owner >> 1]), int(owner & 1), int(needs[owner >> 1, owner & 1]), int(h)))
        return found

    assert len(sent) == 8 and owned(sent) == owned(once)


def test_pairs_by_sizes_leave_out_those_of_a_component(spark):
    rng = random.Random(5)
    rows = [(g, 100 * g + i, 20, rng.randrange(3), rng.randrange(3), 100 * g + (0 if i < 20 else i)) for g in range(3) for i in range(25)]
    described = spark.createDataFrame(rows, "g long, doc_id long, n long, n_added long, n_lost long, component long")
    near = [r for r in rows if 180 * r[3] <= 20 * (r[2] + r[2] * 100 // 80)]
    wanted = {
        (a[1], b[1])
        for a in near
        for b in near
        if a[0] == b[0] and a[5] < b[5] and 180 * (a[3] + b[3] + abs(a[4] - b[4])) <= 20 * (a[2] + b[2])
    }
    pairs = ngram_join._by_sizes(described)
    assert {(r.doc_id, r.hub) for r in pairs.collect()} == wanted and pairs.count() == len(wanted) > 0
    join = pairs._jdf.queryExecution().optimizedPlan().toString()
    assert "largest" in join  # the 20 sets of a group's largest component meet the 5 others alone


def test_similarity_join_of_nothing(spark):
    assert ngram_join.join_similar(plain.empty(spark)).count() == 0


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, i) for i in range(101, 130)] + [(7, 7)]
    random.Random(0).shuffle(edges)
    found = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.node: r.component for r in found} == {**{i: 1 for i in range(1, 41)}, **{i: 100 for i in range(100, 130)}}
    assert len(found) == 70


def lines_gone(rows):
    big = 1 << 62
    lines = []
    for i, t in rows:
        for n, line in enumerate((t or "").split("\n")):
            words = frozenset(plain.WORD.findall(plain.lower(line)))
            if words:
                lines.append(((big if i is None else i, n), words))
    return {
        at for at, a in lines if any(at2 < at and 5 * len(a & b) >= 4 * len(a | b) for at2, b in lines)
    }


def line_rows():
    rng = random.Random(5)
    rows = []
    for i in range(25):
        lines = [plain.sentence(rng, rng.randrange(1, 30), 150) for _ in range(6)]
        if i > 3:
            lines.insert(2, rng.choice(rng.choice(rows)[1].split("\n")))
            words = rng.choice(rng.choice(rows)[1].split("\n")).split() or ["x"]
            words[rng.randrange(len(words))] = "changed"
            lines.append(" ".join(words))
        rows.append((i * 5 % 26, "\n".join(lines)))
    long = [f"v{rng.randrange(5000)}" for _ in range(300)]
    for i in range(4):
        long = long[:]
        for _ in range(14):
            long[rng.randrange(300)] = f"q{rng.randrange(50)}"
        rows.append((100 + i, "short\n\n" + " ".join(long)))
    return [*rows, (None, rows[0][1]), (200, None), (201, ""), (202, "\n \n"), rows[3]]


@pytest.mark.parametrize("few, listed", [(3, 128), (1, 128), (1, 0), (1, 2)])
def test_line_dedup_is_exact(spark, monkeypatch, few, listed):
    monkeypatch.setattr(line_dedup, "FEW", few)
    monkeypatch.setattr(line_dedup, "LISTED", listed)
    docs, rows = plain.documents(spark, line_rows())
    found = {(r.doc_id, r.line) for r in line_dedup.removed_lines(docs).collect()}
    expected = {(None if i == 1 << 62 else i, n) for i, n in lines_gone(rows)}
    assert found == expected


def test_lines_of_one_template_are_exact(spark, monkeypatch):
    # each line shares its rarest words with many that are not similar enough: all three ways are taken
    monkeypatch.setattr(line_dedup, "LISTED", 4)
    monkeypatch.setattr(line_dedup, "PAIRS_AT_ONCE", 50)
    monkeypatch.setattr(line_dedup, "PAIRS_HELD", 60)
    rng = random.Random(9)
    rows = []
    for i in range(60):
        words = [f"t{k}" for k in range(17)] + [f"u{rng.randrange(12)}" for _ in range(4)]
        rows.append((i, " ".join(words) + "\n" + plain.sentence(rng, 8, 20)))
    docs, rows = plain.documents(spark, rows)
    found = {(r.doc_id, r.line) for r in line_dedup.removed_lines(docs).collect()}
    assert found == lines_gone(rows)


def test_sets_of_long_texts_and_repeated_words():
    texts = [b"", b"A b a\n\nb A", b"x " * 200_000 + b"\n" + b" ".join(b"w%d" % i for i in range(200_000)), b"\n"]
    lines = line_dedup.Lines([1, 2, None, 4], texts)
    assert lines.sets.size.tolist() == [2, 2, 1, 200_000]
    assert lines.number.tolist() == [0, 2, 0, 1]
    assert lines.id.tolist() == [2, 2, line_dedup.NO_ID, line_dedup.NO_ID]
    assert lines.name[0] == lines.name[1]
    assert all(len(lines.sets.of(i)) == lines.sets.size[i] for i in range(4))


def test_texts_are_picked_by_id_before_they_are_shuffled(spark):
    ids = [0, -1, 7, 1 << 40, line_dedup.NO_ID, -(1 << 63), *range(100, 1100)]
    texts = spark.createDataFrame([(i, f"t{i}") for i in ids], "doc_id long, text string").repartition(5)
    asked = [*ids[:6], *range(100, 140), 5000]
    found = line_dedup._with_ids(texts, spark.createDataFrame([(i,) for i in asked], "doc_id long").repartition(3))
    got = {(r.doc_id, r.text) for r in found.collect()}
    assert {(i, f"t{i}") for i in ids if i in asked} <= got and len(got) < 60
    assert line_dedup._with_ids(texts, texts.limit(0)).count() == 0


def test_texts_are_not_picked_and_cut_in_one_task(spark):
    texts = spark.createDataFrame([(i, f"a b{i}\nc") for i in range(9)], "doc_id long, text string")
    names = line_dedup.Lines([4], [b"a b4"]).name.view(np.int64).tolist()
    sets = line_dedup._sets_of(texts, spark.createDataFrame([(4, names), (7, names)], "doc_id long, names array<long>"))
    assert [r.name for r in sets.collect()] == names
    plan = sets._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" in plan and "BroadcastHashJoin" not in plan  # a worker a task, not two


def test_lines_of_given_cells():
    texts = [t.encode() for _, t in line_rows() if t]
    every = line_dedup.Lines([*range(len(texts))], texts)
    cells = np.zeros(line_dedup.CELLS, dtype=bool)
    cells[every.sets.hashes[::97] % np.uint64(line_dedup.CELLS)] = True
    some = line_dedup.Lines([*range(len(texts))], texts, cells)
    hit = [cells[every.sets.of(i) % np.uint64(line_dedup.CELLS)].any() for i in range(len(every.name))]
    for column in ("name", "id", "number", "doc"):
        assert getattr(some, column).tolist() == getattr(every, column)[hit].tolist()
    assert [some.sets.of(i).tolist() for i in range(len(some.name))] == [every.sets.of(i).tolist() for i in np.flatnonzero(hit)]


@pytest.mark.parametrize("held", [4, 40, 1 << 22])
def test_lists_are_shorter_where_pairs_do_not_fit(spark, monkeypatch, held):
    monkeypatch.setattr(line_dedup, "LISTED", 32)
    monkeypatch.setattr(line_dedup, "LEAST", 2)
    monkeypatch.setattr(line_dedup, "PAIRS_AT_ONCE", 20)
    monkeypatch.setattr(line_dedup, "PAIRS_HELD", held)
    rng = random.Random(11)
    rows = [(i, " ".join([f"t{k}" for k in range(17)] + [f"u{rng.randrange(12)}" for _ in range(4)])) for i in range(70)]
    docs, rows = plain.documents(spark, rows)
    assert {(r.doc_id, r.line) for r in line_dedup.removed_lines(docs).collect()} == lines_gone(rows)


def test_sets_of_many_lines_hold_their_words():
    rng = random.Random(3)
    texts = [[f"{'w' * rng.choice([0, 1, 7, 8, 9, 63, 64, 70])}{rng.randrange(40)}" for _ in range(rng.randrange(1, 9))] for _ in range(900)]
    lines = line_dedup.Lines([1], ["\n".join(" ".join(t) for t in texts).encode()])
    word = {}
    for i, t in enumerate(texts):
        one = line_dedup.Lines([1], [" ".join(t).upper().encode()])
        assert lines.sets.of(i).tolist() == one.sets.of(0).tolist() == sorted(set(one.sets.of(0).tolist()))
        assert lines.name[i] == one.name[0] and len(set(t)) == lines.sets.size[i]
        word |= {w: line_dedup.Lines([1], [w.encode()]).sets.of(0)[0] for w in set(t) - set(word)}
        assert {int(word[w]) for w in t} == set(lines.sets.of(i).tolist())
    assert len(set(word.values())) == len(word)


def test_bitmaps_of_unlike_widths_bound_the_difference():
    rng = np.random.default_rng(8)
    pool = rng.integers(0, 1 << 56, 900, dtype=np.uint64)
    some = [np.sort(rng.choice(pool, n, replace=False)) for n in (3, 64, 65, 160, 161, 400, 401, 800)]
    sets = line_dedup.Sets(np.concatenate(some), np.repeat(np.arange(8), [len(x) for x in some]), 8)
    assert line_dedup._widths(sets.size).tolist() == [1, 1, 2, 2, 4, 4, 8, 8]
    wide = line_dedup._bitmaps(sets, 8)
    for words in (4, 2, 1):
        wide = line_dedup._folded(wide)
        assert wide.tolist() == line_dedup._bitmaps(sets, words).tolist()
        for i in range(8):
            for j in range(8):
                apart = np.bitwise_count(wide[i] ^ wide[j]).sum()
                assert apart <= len(np.setxor1d(some[i], some[j]))


def test_entries_are_small_and_whole():
    rng = random.Random(4)
    texts = [" ".join(f"v{rng.randrange(3000)}" for _ in range(rng.randrange(1, 90))) for _ in range(400)]
    rows = pa.record_batch({"doc_id": pa.array(range(400), pa.int64()), "text": texts})
    rank = np.full(line_dedup.CELLS, 2, dtype=np.uint8)
    sent = pa.Table.from_batches(line_dedup._send_entries(rank, 50)(iter([rows])))
    lines = line_dedup.Lines([*range(400)], [t.encode() for t in texts])
    size = lines.sets.size[lines.earliest()]
    prefix = size - -(-size * 4 // 5) + 1
    entries = [line_dedup._unpacked(x, line_dedup.ENTRY) for x in sent["entries"].to_pylist()]
    assert len(sent) == 50 and sum(map(len, entries)) == prefix.sum()
    assert set(np.concatenate(entries)["name"].tolist()) == set(lines.name.tolist())
    moved = sum(len(pa.compress(x, "lz4_raw", asbytes=True)) for c in ("entries", "bits") for x in sent[c].to_pylist())
    assert moved < 30 * prefix.sum()  # 36 bytes each before


def test_lines_are_cut_from_texts(spark):
    docs, rows = plain.documents(spark, line_rows())
    gone = lines_gone(rows)
    expected = [
        (i, t if t is None else "\n".join(x for n, x in enumerate(t.split("\n")) if (1 << 62 if i is None else i, n) not in gone))
        for i, t in rows
    ]
    found = line_dedup.remove_lines(docs)
    assert found.columns == docs.columns
    assert sorted(map(str, expected)) == sorted(str((r.doc_id, r.text)) for r in found.collect())
    assert line_dedup.remove_lines(plain.empty(spark)).count() == 0
