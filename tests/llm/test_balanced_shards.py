import zlib
from collections import Counter, defaultdict

import pytest

from tidemark.llm import balanced_shards as op


def check(rows, placed, shards):
    assert len(placed) == len(rows)
    counts = Counter(r.shard for r in placed)
    sizes = [counts.get(s, 0) for s in range(shards)]
    assert sum(sizes) == len(rows) and max(sizes) - min(sizes) <= 1
    slots = defaultdict(list)
    for r in placed:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    expected = sorted(
        ((d, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for d, t in rows), key=repr
    )
    assert sorted(((r.doc_id, r.size, r.text_crc32) for r in placed), key=repr) == expected
    assert {(r.law, r.grown_shard) for r in placed} <= {("rows", None)}


def test_law_and_groups(frame, prose):
    texts = [prose(12) for _ in range(30)]
    rows = [(i, texts[i % 30] if i % 3 else f"only {i}") for i in range(900)]
    placed = op.balanced_shards(frame(rows), 8).collect()
    check(rows, placed, 8)
    apart = op.cut_share(op.balanced_shards(frame(rows), 8)).first()
    # Spread by chance, about seven of eight copies would be apart.
    assert apart.copies == 600 and apart.apart < 60


def test_group_larger_than_a_shard_fills_whole_shards(frame):
    rows = [(i, "same text") for i in range(250)] + [(1000 + i, f"t {i}") for i in range(350)]
    placed = op.balanced_shards(frame(rows), 6).collect()
    check(rows, placed, 6)
    held = Counter(r.shard for r in placed if r.doc_id < 1000)
    assert sum(n for _, n in held.most_common(3)) >= 225


@pytest.mark.parametrize("n", [0, 1, 7, 80])
def test_small_tables_and_edge_rows(frame, prose, n):
    rows = [(i, prose(3)) for i in range(n)]
    if n > 10:
        rows += [(None, None), (1, None), (1, None), (2, ""), (3, ""), (5, prose(3, 5)), (5, prose(3, 5))]
        rows += [(None, "é"), (9, prose(20000, "long"))]
    check(rows, op.balanced_shards(frame(rows), 5).collect(), 5)


def test_everything_linked(frame):
    rows = [(i, f"text {i % 5}") for i in range(100)]
    check(rows, op.balanced_shards(frame(rows), 4).collect(), 4)


def test_grants_keep_loads_within_caps():
    wanted, leaving, load, cap = [10, 50, 0], [30, 10, 20], [50, 60, 40], [60, 80, 60]
    share = op.granted(wanted, leaving, load, cap)
    mean = sum(s * w for s, w in zip(share, wanted)) / sum(wanted)
    for s, w, out, n, most in zip(share, wanted, leaving, load, cap):
        assert 0 <= s <= 1 and n + s * w - out * mean <= most + 0.01
    assert share[0] == 1 and 0.4 < share[1] < 1
    assert op.granted([0, 7], [7, 0], [5, 9], [5, 9]) == pytest.approx([1, 0])


@pytest.mark.parametrize("copies, linked", [(2, 1.0), (3, 0.9), (5, 1.0), (20, 1.0), (2, 0.3)])
def test_propagation_places_linked_texts(frame, copies, linked):
    n, shards = 2400, 40
    rows = frame([(i, f"text {i // copies}") for i in range(int(linked * n))])
    quota = op.quotas(n, shards)
    start = op.described(rows).selectExpr("*", f"cast(pmod(xxhash64(doc_id), {shards}) as int) as shard")
    homes = defaultdict(Counter)
    for r in op.propagated(start, quota).collect():
        homes[r.text_id][r.shard] += 1
    apart = sum(sum(h.values()) for h in homes.values() if len(h) > 1)
    load = Counter(s for h in homes.values() for s in h.elements())
    beyond = sum(max(0, load[s] - q) for s, q in enumerate(quota))
    # The rest is what packing places.
    assert sum(load.values()) == linked * n and apart + beyond <= 0.05 * linked * n


@pytest.mark.parametrize("copies, linked", [(2, 1.0), (3, 0.9), (20, 1.0)])
def test_linked_texts_are_not_cut(frame, copies, linked):
    n, shards = 2400, 40
    rows = [(i, f"text {i // copies}" if i < linked * n else f"only {i}") for i in range(n)]
    result = op.balanced_shards(frame(rows), shards)
    placed = result.collect()
    check(rows, placed, shards)
    homes = defaultdict(set)
    for r in placed:
        homes[r.text_id].add(r.shard)
    # At most one for each end of a shard, of 120 to 1,200 texts.
    assert sum(len(h) > 1 for h in homes.values()) < shards
    apart = op.cut_share(result).first()
    assert apart.copies == linked * n and apart.apart < shards * copies // 2


def test_hot_text_among_pairs(frame):
    rows = [(i, "hot") for i in range(700)] + [(1000 + i, f"t {i // 2}") for i in range(1300)]
    result = op.balanced_shards(frame(rows), 8).collect()
    check(rows, result, 8)
    held = Counter(r.shard for r in result if r.doc_id < 1000)
    # Two whole shards; the remainder is a text like others.
    assert [n for _, n in held.most_common(2)] == [250, 250]
