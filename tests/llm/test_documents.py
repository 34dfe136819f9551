"""Operators over documents against brute force, with nulls, repeated rows, ties, long and empty texts."""

import random
import zlib

import numpy as np
import pytest
from brute import groups, leaks, lettered, quality, repeats

from tillflow.llm import decontamination, near_duplicates, quality_rules, repeats as repeat_rows, resharding


def prose(rng, n, words=300):
    return " ".join(rng.choice("abcdefgh") * rng.randint(1, 3) + str(rng.randrange(words)) for _ in range(n))


def ordered(rows):
    return sorted(rows, key=repr)


# --- decontamination


def leak_rows():
    rng = random.Random(5)
    items = [(i, prose(rng, n)) for i, n in enumerate([40, 25, 11, 10, 9, 6, 3, 1])] + [(90, None), (91, ""), (92, "--"), (None, prose(rng, 12))]
    items += [(100, items[1][1].upper()), (101, items[1][1]), (101, items[1][1])]
    docs = [(i, prose(rng, rng.randint(0, 60))) for i in range(40)]
    for i in range(60):
        words = lettered(rng.choice(items[:12])[1])
        a = rng.randint(0, max(0, len(words) - 8))
        docs.append((100 + i, prose(rng, rng.randint(0, 9)) + "\n" + rng.choice(["- ", " ", "..."]).join(words[a : a + rng.randint(5, 30)]) + "é " + prose(rng, rng.randint(0, 9))))
    docs += [(7, docs[50][1]), (None, docs[60][1]), (None, None), (8, ""), (50, docs[50][1]), (9, (items[0][1] + " ") * 300)]
    return docs, items


def test_leaks(docs_of):
    docs, items = leak_rows()
    frame = docs_of([(i, t, 1, "x") for i, t in docs], "doc_id long, text string, key int, n_hit string")
    got = decontamination.leak_report(frame, docs_of([(i, t, 0) for i, t in items], "item_id long, text string, fp int")).collect()
    assert ordered(map(tuple, got)) == ordered(leaks(docs, items))
    assert sum(r.contaminated for r in got) > 5


def test_leaks_with_empty_tables(docs_of):
    docs, items = docs_of([(1, "a b"), (2, None)]), docs_of([], "item_id long, text string")
    assert ordered((r.doc_id, r.n_words, r.contaminated) for r in decontamination.leak_report(docs, items).collect()) == [(1, 2, False), (2, 0, False)]
    assert decontamination.leak_report(docs_of([]), docs_of([(1, "a")], "item_id long, text string")).collect() == []
    assert ordered(decontamination.clean_texts(docs, docs_of([(5, "b")], "item_id long, text string")).collect()) == [(2, None)]


# --- near duplicates


def copies(rng):
    docs = []
    for base in range(12):
        text = prose(rng, rng.randint(5, 120), 5000).split()
        for _ in range(rng.randint(1, 7)):
            new = list(text)
            for _ in range(rng.randint(0, max(1, len(text) // 12))):
                new[rng.randrange(len(new))] = f"z{rng.randrange(9999)}"
            docs.append((len(docs) * 7 % 101, " ".join(new)))
    docs += [(900, None), (901, ""), (902, " \n "), (None, docs[0][1]), (903, "one"), (904, "ONE"), (905, "one two"), (3, docs[5][1]), (3, docs[5][1]), (3, "other text here"), (906, "w " * 3000)]
    return docs


@pytest.mark.parametrize("k", [2, 5])
def test_near_duplicates(docs_of, k):
    docs = copies(random.Random(k))
    group, sizes = groups(docs, k)
    frame = docs_of([(i, t, 0, "x") for i, t in docs], "doc_id long, text string, cid int, tk string")
    got = near_duplicates.near_duplicates(frame, k=k).collect()
    want = []
    for (i, _), g, n in zip(docs, group, sizes):
        ids = [x for (x, _), h in zip(docs, group) if h == g and x is not None]
        component = (min(ids) if ids else None) if n else i
        want.append((i, n, component, i == component))
    assert ordered(map(tuple, got)) == ordered(want)
    if k == 5:
        left = near_duplicates.one_per_group(frame, k=k)
        assert left.columns == frame.columns
        rows = left.collect()
        wordless = sum(1 for n in sizes if not n)
        assert len(rows) == len({g for g, n in zip(group, sizes) if n}) + wordless


def test_near_duplicates_of_an_empty_table(docs_of):
    assert near_duplicates.near_duplicates(docs_of([])).collect() == []


def test_signature_index_guarantee():
    limit = near_duplicates.distance_limit(80)
    chunk = near_duplicates.chunk_of(limit)
    assert (chunk[-1] + 1) * (near_duplicates.CHUNK_ERRORS + 1) > limit  # pigeonhole
    assert near_duplicates.chunk_of(limit - 2)[-1] < chunk[-1]


def test_pairs_are_taken_where_they_meet_first(spark):
    from pyspark.sql import functions as F

    rng = random.Random(8)
    chunk = near_duplicates.chunk_of(near_duplicates.distance_limit(80))
    rows = []
    for i in range(400):
        mask = [0] * 128
        for p in rng.sample(range(128), rng.choice([0, 1, 30, 45, 49])) if i > 128 else [i] if i < 128 else []:
            mask[p] = 1
        errors = [[p for p in range(128) if chunk[p] == c and mask[p]] for c in range(chunk[-1] + 1)]
        c = next((c for c, e in enumerate(errors) if len(e) <= 1), None)
        want = None if c is None else errors[c][0] if errors[c] else int((chunk == c).argmax())
        words = [sum(b << j for j, b in enumerate(mask[h : h + 64])) for h in (0, 64)]
        rows.append((*[w - (1 << 64) if w >> 63 else w for w in words], want))
    # a mask with all chunks but one of two errors or more, and the sign bit alone
    frame = spark.createDataFrame(rows, "low long, high long, want int")
    got = frame.select("want", near_duplicates.first_meeting(F.col("low"), F.col("high"), chunk).alias("got")).collect()
    assert [r.got for r in got] == [r.want for r in got]


@pytest.mark.parametrize("gather", [0, 10**6])
def test_components(spark, gather):
    rng = random.Random(gather)
    edges = [(i, i + 1) for i in range(60)] + [(100 + i, 100) for i in range(40)] + [(rng.randrange(200, 300), rng.randrange(200, 300)) for _ in range(60)] + [(5, 5), (300, 301), (301, 300)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    got = {r.node: r.root for r in near_duplicates.components(spark.createDataFrame(edges, "a long, b long"), gather).collect()}
    assert got == {x: find(x) for x in root if find(x) != x}


def test_a_large_group_without_a_common_center(spark, docs_of):
    """A chain of windows over one long text: only neighbours are similar."""
    words = prose(random.Random(1), 2000, 10**6).split()
    docs = [(i, " ".join(words[i * 10 : i * 10 + 200])) for i in range(150)]
    rows = near_duplicates.near_duplicates(docs_of(docs), k=2).collect()
    assert {r.component_id for r in rows} == {0}


def test_a_group_in_many_blocks(docs_of, monkeypatch):
    """Similar texts around the threshold: groups as by brute force, however few classes a block has."""
    rng = random.Random(9)
    base = prose(rng, 120, 5000).split()
    docs = []
    for i in range(150):
        new = list(base)
        for _ in range(rng.randint(1, 6)):
            new[rng.randrange(len(new))] = f"z{rng.randrange(99999)}"
        docs.append((i, " ".join(new)))
    docs += [(200 + i, prose(rng, 40, 900)) for i in range(20)]
    group, sizes = groups(docs, 2)
    assert 20 < len(set(group)) < 165 and max(group.count(g) for g in set(group)) > 30
    want = [(i, n, min(x for (x, _), h in zip(docs, group) if h == g)) for (i, _), g, n in zip(docs, group, sizes)]
    monkeypatch.setattr(near_duplicates, "FIRST_CENTERS", 1)
    for most in (7, 4096):
        monkeypatch.setattr(near_duplicates, "BLOCK_CLASSES", most)
        got = near_duplicates.near_duplicates(docs_of(docs), k=2).collect()
        assert ordered((r.doc_id, r.n_shingles, r.component_id) for r in got) == ordered(want)


def test_rows_grow_with_classes_and_not_with_pairs(docs_of, monkeypatch):
    """Similar texts that are not linked stand once under their label, not once under each key they share."""
    kept, staged = {}, near_duplicates.staged

    def keeping(df, *parts):
        kept[parts[0]] = staged(df, *parts)
        return kept[parts[0]]

    monkeypatch.setattr(near_duplicates, "staged", keeping)
    rng = random.Random(12)
    base = prose(rng, 150, 5000).split()
    docs = []
    for i in range(160):
        new = list(base)
        for at in rng.sample(range(len(new)), 10):
            new[at] = f"z{rng.randrange(99999)}"
        docs.append((i, " ".join(new)))
    group, _ = groups(docs, 2)
    got = near_duplicates.near_duplicates(docs_of(docs), k=2).collect()
    assert ordered(r.component_id for r in got) == ordered(min(j for j, h in enumerate(group) if h == g) for g in group)
    assert len(set(group)) > 100
    assert 100 < kept["near_members"].count() < 5 * len(docs)


def test_rows_with_partners():
    """Against each pair one by one, under keys of one block and of two."""
    import pyarrow as pa

    rng = np.random.default_rng(6)
    symbols = np.repeat(rng.integers(0, 256, (12, near_duplicates.ALL_HASHES), dtype=np.uint8), 5, axis=0)
    changed = rng.random(symbols.shape) < rng.uniform(0.05, 0.3, (len(symbols), 1))
    symbols[changed] = rng.integers(0, 256, int(changed.sum()))
    symbols = symbols[rng.integers(0, len(symbols), 300)]
    key, two = rng.integers(0, 9, 300), rng.integers(0, 2, 300)
    x, y = np.zeros(300, int), key % 2  # an odd key's rows stand in two blocks, an even one's in one
    part = np.where(y > x, two, 0)
    n, comp = rng.integers(70, 100, 300), rng.integers(0, 60, 300)
    planes = [row.tolist() for row in near_duplicates.bit_planes(symbols)]
    rows = pa.table({"key": key, "x": x, "y": y, "part": part, "comp": comp, "n": n, "p": pa.array(planes, pa.list_(pa.int64()))})
    limit, all_limit = near_duplicates.distance_limit(80), near_duplicates.distance_limit(80, near_duplicates.ALL_HASHES)
    want = set()
    for i in range(300):
        for j in range(300):
            differ = symbols[i] != symbols[j]
            met = key[i] == key[j] and comp[i] != comp[j] and (x[i] == y[i] or part[i] != part[j])
            if met and min(n[i], n[j]) * 100 >= max(n[i], n[j]) * 80 and differ[: near_duplicates.HASHES].sum() <= limit and differ.sum() <= all_limit:
                want |= {i, j}
    assert 20 < len(want) < 280
    assert near_duplicates.near_rows(rows, limit, 80).tolist() == sorted(want)
    assert near_duplicates.near_rows(rows.slice(0, 0), limit, 80).tolist() == []


@pytest.mark.parametrize("same", [False, True])
def test_links_of_two_blocks_only_connect(same):
    """A hot group gives fewer links than it has classes, not its pairs."""
    rng = np.random.default_rng(4)
    sets = [np.unique(np.r_[rng.choice(100, 97 if i < 40 else 60, replace=False), rng.integers(100, 999, 3)]) for i in range(80)]
    values = [near_duplicates.mix(s.astype(np.uint64) + np.uint64(1)) for s in sets]
    planes = near_duplicates.bit_planes(near_duplicates.signatures(values)).view(np.uint64)
    every = near_duplicates.Block(planes, np.array([len(s) for s in sets]), np.arange(80) // 2)
    one, two = (np.arange(80), np.arange(80)) if same else (np.arange(0, 80, 2), np.arange(1, 80, 2))
    links = near_duplicates.new_links(near_duplicates._at(every, one), near_duplicates._at(every, two), [sets[i] for i in one], [sets[i] for i in two], near_duplicates.distance_limit(80), 80)
    pairs = [(one[i], two[j]) for i, j in links]
    assert all(100 * len(np.intersect1d(sets[a], sets[b])) >= 80 * len(np.union1d(sets[a], sets[b])) for a, b in pairs)
    root = {i // 2: i // 2 for i in range(80)}
    for a, b in pairs:
        a, b = root[a // 2], root[b // 2]
        assert a != b  # no ring
        root = {x: a if r == b else r for x, r in root.items()}
    assert len({root[i // 2] for i in range(40)}) == 1 and len(pairs) < 40


# --- repeated strings


def repeated_docs():
    rng = random.Random(3)
    base = ["".join(rng.choice("abé ") for _ in range(60)) for _ in range(6)]
    docs = []
    for i in range(150):
        parts = [rng.choice(base)[rng.randint(0, 20) :] if rng.random() < 0.5 else "".join(rng.choice("abcdef \n") for _ in range(rng.randint(0, 30))) for _ in range(rng.randint(0, 6))]
        docs.append((i, "".join(parts)))
    return docs + [(None, "x" * 500), (5, None), (301, ""), (302, "x" * 100), (303, "ab" * 300), (7, docs[7][1]), (7, docs[7][1]), (7, "ab" * 20)]


@pytest.mark.parametrize("length, block", [(20, 1 << 20), (40, 60), (33, 1000)])
def test_repeated_strings(docs_of, length, block):
    docs = repeated_docs()
    frame = docs_of([(i, t, 5, "x") for i, t in docs], "doc_id long, text string, g int, id string")
    got = repeat_rows.repeat_report(frame, length=length, block_bytes=block).collect()
    want = repeats(docs, length)
    assert ordered(map(tuple, got)) == ordered(w[:5] for w in want)
    if block == 1000:
        texts = repeat_rows.without_repeats(frame, length=length, block_bytes=block)
        assert texts.columns == frame.columns
        kept = [(i, None if t is None else w[5].decode(errors="ignore")) for (i, t), w in zip(docs, want)]
        assert ordered((r.doc_id, r.text) for r in texts.collect()) == ordered(kept)


def test_repeats_of_a_long_text_meet_across_its_parts(docs_of, monkeypatch):
    rng = random.Random(9)
    monkeypatch.setattr(repeat_rows, "SLICE_BYTES", 1000)
    long = "".join(rng.choice("abcdefghij") for _ in range(9000))
    docs = [(1, long), (2, "xx" + long[990:1300]), (3, "other")]
    column = __import__("pyarrow").array([t for _, t in docs])
    parts = [p for p in repeat_rows.long_slices(column, 100)]
    assert len(parts) > 5  # the long text is cut, and every string lies in one part
    got = repeat_rows.repeat_report(docs_of(docs), length=100).collect()
    assert ordered(map(tuple, got)) == ordered(w[:5] for w in repeats(docs, 100))


def test_repeats_of_empty_tables(docs_of):
    assert repeat_rows.repeat_report(docs_of([])).collect() == []


# --- quality rules


def quality_docs():
    rng = random.Random(2)
    common = "Accept ALL cookies  now please\t"
    docs = []
    for i in range(80):
        lines = [prose(rng, rng.randint(0, 12)) for _ in range(rng.randint(0, 6))]
        if i % 3 == 0:
            lines.insert(0, common if i % 2 else common.lower().strip())
        if i % 5 == 0:
            lines += lines[:3]
        docs.append((i, "\n".join(lines) + (" #$% <&" if i % 7 == 0 else ""), "one" if i % 4 else "two"))
    docs += [(None, "word " * 25 + "\n" + common, "one"), (1, docs[1][1], "one"), (1, docs[1][1], "one"), (200, None, None), (201, "", None), (202, "\n\n", ""),
             (203, "a b c d e f g h " * 2, "one"), (204, (common + "\n") * 6, "one"), (205, "été\x0b ünd " * 15, "two"), (206, "long" * 20000, "two")]
    return docs


def test_quality_rules(docs_of):
    docs = quality_docs()
    frame = docs_of([(i, t, h, 1, "x") for i, t, h in docs], "doc_id long, text string, source string, quality int, kept string")
    got = quality_rules.quality_rules(frame).collect()
    want = quality(docs)
    assert ordered(map(tuple, got)) == ordered(w for w, _ in want)
    assert {r.kept for r in got} == {True, False} and any(r.n_removed_words for r in got)
    texts = quality_rules.kept_texts(frame)
    assert texts.columns == frame.columns
    assert ordered((r.doc_id, r.text) for r in texts.collect()) == ordered((w[0], left if w[7] else t) for (w, left), (_, t, _) in zip(want, docs) if w[8])


def test_near_copies_keep_their_lines(docs_of):
    """A large group of near copies stays, whole; a line of otherwise different texts still goes."""
    rng = random.Random(12)
    footer = "all rights reserved by the owner of this site"
    docs = [(i, "\n".join([prose(rng, 12, 10**6) for _ in range(4)] + [footer]), "one") for i in range(60)]
    base = [prose(rng, 12, 10**6) for _ in range(10)]
    for i in range(60):
        lines = list(base)
        lines[rng.randrange(10)] = prose(rng, 12, 10**6)
        docs.append((100 + i, "\n".join(lines), "one"))
    docs.append((200, footer + "\n" + footer + " " + "\n" + footer, "one"))
    frame = docs_of(docs, "doc_id long, text string, source string")
    got = {r.doc_id: (r.n_removed_words, r.kept) for r in quality_rules.quality_rules(frame).collect()}
    assert got == {i: (0, True) if 100 <= i < 200 else (27, False) if i == 200 else (9, True) for i, _, _ in docs}
    texts = {r.doc_id: r.text for r in quality_rules.kept_texts(frame).collect()}
    assert texts == {i: t if i >= 100 else t.removesuffix("\n" + footer) for i, t, _ in docs if i != 200}


def test_quality_rules_of_an_empty_table(docs_of):
    assert quality_rules.quality_rules(docs_of([], "doc_id long, text string, source string")).collect() == []


def test_quality_rules_run_no_python(docs_of, capsys):
    quality_rules.quality_rules(docs_of([(1, "a", "b")], "doc_id long, text string, source string")).explain()
    assert not any(word in capsys.readouterr().out for word in ("Python", "Arrow", "Pandas"))


# --- resharding


def test_moves_cost_least():
    sizes, room = [50, 10, 0, 40], [25, 25, 25, 25]
    moves = resharding.cheapest_moves(sizes, room)
    assert [sum(n for (i, _), n in moves.items() if i == k) for k in range(4)] == sizes
    assert [sum(n for (_, j), n in moves.items() if j == k) for k in range(4)] == room
    assert sum(n for (i, j), n in moves.items() if i != j) == sum(max(0, s - r) for s, r in zip(sizes, room))
    assert resharding.cheapest_moves([7, 3, 5], [9, 6]) and resharding.cheapest_moves([], []) == {}
    with pytest.raises(ValueError):
        resharding.cheapest_moves([1], [2])


def shard_docs():
    rng = random.Random(4)
    docs = [(i, prose(rng, rng.randint(0, 80)), "hot" if i % 3 else f"s{i % 11}") for i in range(600)]
    return docs + [(None, "x", "a"), (None, None, None), (601, "", "a"), (5, docs[5][1], "hot"), (5, docs[5][1], "hot")]


def test_sharding(spark, docs_of, workdir, monkeypatch):
    monkeypatch.setattr(resharding, "BLOCK_ROWS", 50)
    docs = shard_docs()
    frame = docs_of([(*d, 1) for d in docs], "doc_id long, text string, source string, shard int")
    rows = resharding.shard_documents(frame).collect()
    size = lambda t: len((t or "").encode()) + 1
    assert ordered((r.doc_id, r.size, r.text_crc32) for r in rows) == ordered((i, size(t), zlib.crc32((t or "").encode())) for i, t, _ in docs)
    by = {s: [r for r in rows if r.shard == s] for s in range(8)}
    assert all(sorted(r.slot for r in got) == list(range(len(got))) for got in by.values())
    total = [sum(r.size for r in got) for got in by.values()]
    assert max(total) - min(total) <= 8 * max(size(t) for _, t, _ in docs) // 4
    assert {(r.law, r.grown_shard) for r in rows} == {("bytes", None)}
    assert resharding.shard_documents(docs_of([], "doc_id long, text string, source string")).collect() == []


def test_only_affected_shards_are_written(spark, docs_of, workdir):
    from pyspark.sql import functions as F

    rows = docs_of([(i, "x" * (i % 7)) for i in range(300)]).withColumn("size", F.lit(10))
    placed = resharding.reshard(rows, F.col("size"), F.when(F.col("doc_id") < 100, 0).when(F.col("doc_id") < 250, 1).otherwise(2), ["doc_id"], 3, 3, [1000, 1000, 1000])
    written = dict(map(tuple, resharding.rewrite_affected(placed, f"{workdir}/shards").collect()))
    assert written == {1: 100, 2: 100}  # shard 0 keeps its rows
    assert placed.filter("_old_shard <> shard").count() == 50
