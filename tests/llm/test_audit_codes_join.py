"""Filter audit, vector codes and parity join against brute force, on odd rows too."""

import collections
import hashlib
import itertools
import math
import random
import re
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from farebox.llm import filter_audit, parity_join, vector_codes
from farebox.llm.components import Sets

WORD = re.compile(r"[^\x20\x09-\x0D]+")


# --- filter audit ---

def failures(rows):
    first = {}
    for i, text, *_ in rows:
        if i is not None:
            first[text or ""] = min(i, first.get(text or "", i))
    for i, text, part in rows:
        text = text or ""
        words = WORD.findall(text)
        yield part or "", "".join(letter for letter, bad in zip("ABCDE", (
            len(words) < 100, 100 * len(set(words)) < 80 * len(words),
            100 * len(re.findall("[A-Z]", text)) > 10 * len(text), re.search("[#$%&*|]", text),
            i is not None and i > first[text])) if bad)


def plain_audit(rows, labels):
    good = {i for i, q, _ in labels if q == 1} - {None}
    toxic = {i for i, _, t in labels if t == 1} - {None}
    by_part = collections.defaultdict(list)
    for (i, *_), (part, failed) in zip(rows, failures(rows)):
        by_part[part].append((failed, i in good, i in toxic))
    out = {}
    for part, docs in by_part.items():
        total = collections.Counter()
        for order in map("".join, itertools.permutations("ABCDE")):
            left = docs
            for step, letter in enumerate(order, 1):
                gone = [d for d in left if letter in d[0]]
                left = [d for d in left if letter not in d[0]]
                total[letter] += len(gone)
                out[part, order, step] = [
                    len(left), len(gone), sum(letter in d[0] for d in docs) - len(gone),
                    sum(d[0] == letter for d in docs), sum(d[1] for d in gone), sum(d[2] for d in gone)]
        for (p, order, step), values in out.items():
            if p == part:
                values.append(total[order[step - 1]])
    return out


def audited(spark, rows, labels):
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumns(
        {c: F.lit(1) for c in ("part", "sha", "own", "n", "is_good", "first", "mask")})
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumn("lang", F.lit("x"))
    found = filter_audit.audit(docs, marks).collect()
    return {(r.part, r.filter_order, r.step): list(r[3:]) for r in found}


def test_audit_is_the_filters_one_by_one(spark):
    draw = random.Random(5)
    words = [f"w{k}" for k in range(300)]
    texts = [None, "", " \t\n", "A#B", "one", "É Ü ß x", " ".join(words[:100]), " ".join(words[:80] * 2),
             " ".join(words[:120]).upper(), " ".join(words) + " | a", "word " * 30_000]
    rows = [(draw.choice([None, *range(40)]), draw.choice(texts), draw.choice([None, "en", "de"])) for _ in range(120)]
    rows += rows[:5] + [(7, "same", "en")] * 3 + [(9, "same", "de"), (None, "same", "de")]
    labels = [(k, draw.choice([0, 1, None]), draw.choice([0, 1, None])) for k in range(30)]
    labels += [(3, 1, 0), (3, 0, 1), (None, 1, 1)]
    assert audited(spark, rows, labels) == plain_audit(rows, labels)


def test_audit_of_nothing(spark):
    assert audited(spark, [], [(1, 1, 1)]) == {}
    found = audited(spark, [(None, None, None)], [])
    assert len(found) == 600 and found["", "ABCDE", 1] == [0, 1, 0, 1, 0, 0, 120]


@given(st.lists(st.integers(0, 50), min_size=32, max_size=32))
@settings(max_examples=30, deadline=None)
def test_least_squares_solution_is_the_mean_over_orders(values):
    v = [0] + values[1:]
    solution = filter_audit.shapley_solution(5)
    for player in range(5):
        mean = Fraction(0)
        for order in itertools.permutations(range(5)):
            before = sum(1 << p for p in order[:order.index(player)])
            mean += v[before | 1 << player] - v[before]
        assert sum(c * x for c, x in zip(solution[player], v)) == mean / math.factorial(5)


# --- vector codes ---

def plain_codes(rows):
    kept = [(i, [math.floor(256 * x) for x in v], label) for i, v, label in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    if not kept:
        return []
    width = max(1, -(-max(len(v) for _, v, _ in kept) // 16))
    kept = [(i, v + [0] * (16 * width - len(v)), label) for i, v, label in kept]
    first = sorted(kept, key=lambda r: (r[0] is None, r[0], r[1]))[:64]
    part = lambda v, p: v[p * width:(p + 1) * width]
    books = [[part(v, p) for _, v, _ in first] for p in range(16)]

    def nearest(p, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), k) for k, e in enumerate(books[p]))

    for _ in range(2):
        for p in range(16):
            groups = collections.defaultdict(list)
            for _, v, _ in kept:
                groups[nearest(p, part(v, p))[1]].append(part(v, p))
            for k, members in groups.items():
                books[p][k] = [sum(c) // len(members) for c in zip(*members)]
    out, per_label = [], collections.Counter()
    for i, v, label in kept:
        found = [nearest(p, part(v, p)) for p in range(16)]
        error = sum(d for d, _ in found)
        per_label[label] += error
        out.append((i, "".join(f"{k:02x}" for _, k in found), error, label))
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return sorted(((i, c, e, per_label[label], digest) for i, c, e, label in out), key=repr)


VECTORS = "vec_id long, embedding array<float>, label int"


def coded(spark, rows):
    frame = spark.createDataFrame(rows, VECTORS).withColumns({c: F.lit(0) for c in ("x", "k", "code", "part")})
    return sorted((tuple(r) for r in vector_codes.vector_codes(frame).collect()), key=repr)


@pytest.mark.parametrize("dims, scale, n", [(64, 1, 150), (16, 0.02, 200), (48, 30, 90)])
def test_codes_are_the_nearest_entries(spark, dims, scale, n):
    draw = np.random.default_rng(dims)
    rows = [(k, np.float32(x).tolist(), int(k % 3) if k % 7 else None)
            for k, x in enumerate(draw.normal(0, scale, (n, dims)))]
    rows += [(None, rows[3][1], 5), (None, rows[4][1], None), (2, rows[5][1], 1), *rows[:3]]
    rows += [(900, None, 1), (901, [None] * dims, 1), (902, [math.nan] * dims, 1), (903, [math.inf] + [0.0] * (dims - 1), 1)]
    draw.shuffle(rows)
    assert coded(spark, rows) == plain_codes(rows)


def test_codes_of_few_short_and_no_vectors(spark):
    rows = [(1, [0.5] * 20, 0), (2, [1.5] * 3, 0), (3, [], 1), (3, [], 1)]
    assert coded(spark, rows) == plain_codes(rows)
    assert coded(spark, [(1, [], None)]) == plain_codes([(1, [], None)])
    assert coded(spark, []) == [] == coded(spark, [(1, None, 0)])


@given(st.lists(st.lists(st.integers(-6, 6), min_size=3, max_size=3), min_size=1, max_size=64),
       st.lists(st.lists(st.integers(-9, 9), min_size=3, max_size=3), min_size=1, max_size=20))
@settings(max_examples=100, deadline=None)
def test_masks_hold_the_nearest_entry_and_all_that_tie(entries, points):
    books = vector_codes.Codebooks(np.array([entries], np.int64))
    x = np.array(points, np.int64)
    squared = ((x[:, None] - np.array(entries)[None]) ** 2).sum(2)
    mask = books.candidates(0, x)
    found, best = books.nearest(0, x)
    assert (found == squared.argmin(1)).all() and (best == squared.min(1)).all()
    for row, bits in zip(squared, mask.tolist()):
        assert all(bits >> int(e) & 1 for e in np.flatnonzero(row == row.min()))


# --- parity join ---

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingled(text):
    words = WORD.findall((text or "").translate(LOWER))
    return frozenset(tuple(words[k:k + 5]) for k in range(max(1, len(words) - 4))) if words else frozenset()


def plain_join(rows):
    """n_shingles and component of every row, all pairs of distinct sets compared."""
    sets = sorted({shingled(t) for _, t in rows} - {frozenset()}, key=sorted)
    parent = list(range(len(sets)))

    def find(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for a, b in itertools.combinations(range(len(sets)), 2):
        both = len(sets[a] & sets[b])
        if 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
            parent[find(a)] = find(b)
    place = {s: find(k) for k, s in enumerate(sets)}
    least = {}
    for i, t in rows:
        if i is not None and shingled(t):
            root = place[shingled(t)]
            least[root] = min(i, least.get(root, i))
    return sorted(((i, len(shingled(t)), least.get(place[shingled(t)]) if shingled(t) else i) for i, t in rows), key=repr)


def joined(spark, rows, **options):
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns(
        {c: F.lit(1) for c in ("node", "size", "key", "class", "print")})
    return sorted((tuple(r) for r in parity_join.near_sets(docs, **options).collect()), key=repr)


def edited_texts(seed, families, copies):
    """Texts in families, each copy with some words changed, so that similarities lie around 0.8."""
    draw = random.Random(seed)
    vocabulary = [f"v{k}" for k in range(4_000)]
    passage = draw.choices(vocabulary, k=40)
    rows = []
    for _ in range(families):
        base = draw.choices(vocabulary, k=draw.choice([1, 3, 5, 8, 20, 66, 70, 120, 300]))
        if draw.random() < 0.4:
            base = base + passage
        for _ in range(draw.randrange(1, copies)):
            words = list(base)
            for _ in range(draw.randrange(0, 2 + len(words) // 30)):
                words[draw.randrange(len(words))] = draw.choice(vocabulary)
            rows.append((len(rows) if draw.random() < 0.95 else None, draw.choice([" ", "\n", "  "]).join(words)))
    return rows + [(5, rows[0][1].upper()), rows[1], rows[1], (-4, None), (None, ""), (8, " \t")]


@pytest.mark.parametrize("options", [{}, {"spread": 0.2}])
def test_join_is_all_pairs(spark, options, monkeypatch):
    """With few segments nearly every set has too few keys and meets its whole band."""
    monkeypatch.setattr(parity_join, "BLOCK", 3)
    rows = edited_texts(11, 60, 8)
    assert joined(spark, rows, **options) == plain_join(rows)


def test_join_of_odd_rows(spark, odd_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    assert joined(spark, rows) == plain_join(rows)
    assert parity_join.near_sets(no_docs).count() == 0
    assert joined(spark, [(1, None), (None, "")]) == sorted([(1, 0, 1), (None, 0, None)], key=repr)


def test_a_key_of_more_sets_than_a_list_holds(spark):
    """One family of 2,300 sets, and two texts that share half of it but are not linked."""
    base = [f"b{k}" for k in range(60)]
    rows = [(k + 10, " ".join([*base, f"own{k}"])) for k in range(2_300)]
    rows += [(1, " ".join(base[:30] + [f"x{k}" for k in range(30)])), (2, " ".join(base[30:] + [f"y{k}" for k in range(30)]))]
    found = {i: c for i, _, c in joined(spark, rows)}
    assert found[1] == 1 and found[2] == 2 and {c for i, c in found.items() if i >= 10} == {10}


def test_a_large_group_of_near_copies(spark, monkeypatch):
    """Similarities around 0.8, so that classes still differ after the closest pairs were checked."""
    draw, rows = random.Random(5), []
    base = [f"b{k}" for k in range(100)]
    for k in range(400):
        words = list(base)
        for place in draw.sample(range(100), draw.choice([2, 3, 4])):
            words[place] = f"own{k}.{place}"
        rows.append((k, " ".join(words)))
    doubtful, stage = [], parity_join.staged

    def seen(frame, name):
        out = stage(frame, name)
        if name == "doubtful":
            doubtful.append(out.count())
        return out

    monkeypatch.setattr(parity_join, "staged", seen)
    assert joined(spark, rows) == plain_join(rows)
    assert doubtful and doubtful[0] > 0


def test_a_bucket_reports_fewer_pairs_than_twice_its_members(spark):
    """200 sets of a class each, all close to one another: 19,900 pairs."""
    known = spark.createDataFrame(
        [(k, 100, (1 << k % 60 | 1 << 100 + k % 50).to_bytes(64, "little"), k) for k in range(200)],
        "node long, size long, sketch binary, class long")
    lists = spark.createDataFrame([(7, 0, list(range(200)))], "bucket long, leader long, members array<long>")
    found = parity_join._candidates(lists, known).collect()
    assert len(found) < 400 and all(r.cut for r in found if r.a > 0)
    reached = Sets()
    for r in found:
        reached.join(r.a, r.b)
    assert {reached.find(k) for k in range(200)} == {0}


@given(st.lists(st.tuples(st.integers(0, 12), st.integers(0, 12), st.integers(0, 5)), max_size=60))
def test_forest_connects_what_pairs_connect_closest_first(pairs):
    pairs = [p for p in pairs if p[0] != p[1]]
    low, high, apart = (np.array([p[k] for p in pairs], np.int64) for k in range(3))
    taken = parity_join.nearest_forest(low, high, apart)
    every, by_distance, forest, least = Sets(), Sets(), Sets(), 0
    for a, b, d in sorted(pairs, key=lambda p: p[2]):
        every.join(a, b)
        least += d if by_distance.join(a, b) else 0
    assert all(forest.join(*pairs[k][:2]) for k in taken)
    assert all(forest.find(k) == every.find(k) for k in range(13)) and apart[taken].sum() == least


@given(st.integers(0, 10**6), st.integers(30, 400), st.floats(0, 0.12))
@settings(max_examples=60, deadline=None)
def test_linked_sets_share_a_key_and_pass_the_sketch(seed, size, share):
    """Sets at any distance that still links them: a common key among the first ones, sketches close."""
    draw = np.random.default_rng(seed)
    both = draw.integers(0, 2**64 - 1, size, dtype=np.uint64)
    one = draw.integers(0, 2**64 - 1, int(size * share), dtype=np.uint64)
    two = draw.integers(0, 2**64 - 1, int(size * 0.12) - len(one) if share < 0.12 else 0, dtype=np.uint64)
    sets = [np.unique(np.concatenate([both, x])) for x in (one, two)]
    value, starts = np.concatenate(sets), np.array([0, len(sets[0]), len(sets[0]) + len(sets[1])])
    union = len(sets[0]) + len(sets[1]) - len(both)
    assert 100 * len(both) >= 80 * union
    ranks = draw.integers(0, 255, parity_join.SLOTS).astype(np.uint8)
    row, key = parity_join.segment_keys(value, starts, ranks)
    assert not any(parity_join.too_few(value, starts, parity_join.SPREAD))
    assert set(key[row == 0].tolist()) & set(key[row == 1].tolist())
    words = [np.frombuffer(s, "<u8") for s in parity_join.sketches(value, starts)]
    size_of = np.diff(starts)
    a, b, apart = parity_join.close_pairs(np.array([0]), np.array([1]), words, size_of)
    assert len(a) == 1 and apart[0] <= len(one) + len(two)


def test_shingles_of_a_batch_do_not_cross_texts():
    texts = ["a b c d e f", "A  b\tc d\ne f", "", "e f", "f e", "é a b c d"]
    owner, value = parity_join.shingle_sets(pa.array(texts, pa.large_string()))
    sets = [frozenset(value[owner == k].tolist()) for k in range(len(texts))]
    assert [len(s) for s in sets] == [len(shingled(t)) for t in texts]
    assert sets[0] == sets[1] and len(set(sets)) == 5
