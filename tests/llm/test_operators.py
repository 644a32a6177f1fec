"""Operators on odd input, and against brute force."""

import collections
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from farebox.llm import (
    bagminhash, cached_encoder, components, exact_dedup, multiset_hash, near_dedup, packing,
    piece_codec, quality, surrogates, token_counts, token_files, url_templates,
)

WORDS = public_tokenizers.path("word_bpe_49k.json")
BYTES = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def rows(frame):
    return [(r.doc_id, r.text or "") for r in frame.collect()]


def library(path):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    return lambda text: tokenizer.encode(text, add_special_tokens=False).ids


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


TEXT = st.text(st.sampled_from("abthe  .,'!-\n\t09éßñ日Σ́\u00a0\u2003▁😀<|>"), max_size=60)


@pytest.mark.parametrize("path", [WORDS, BYTES])
@settings(deadline=None, max_examples=150)
@given(texts=st.lists(TEXT, max_size=6))
def test_cached_encoder_is_the_library(path, texts):
    ids, offsets = cached_encoder.encoder(path).encode(pa.array(texts, pa.large_string()))
    encode = cached_encoder.encoder(path).tokenizer.encode
    for k, text in enumerate(texts):
        assert ids[offsets[k]:offsets[k + 1]].tolist() == encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("path", [WORDS, BYTES])
@settings(deadline=None, max_examples=100)
@given(texts=st.lists(st.text(st.sampled_from("abZ09~~'  \n\té<s|>"), max_size=40), max_size=6))
def test_marks_in_texts_are_not_taken_for_marks(path, texts):
    source = cached_encoder.encoder(path)
    ids, offsets = source.encode(pa.array(texts, pa.large_string()))
    for k, text in enumerate(texts):
        assert ids[offsets[k]:offsets[k + 1]].tolist() == source.tokenizer.encode(text, add_special_tokens=False).ids


def test_the_library_gets_many_words_at_once(monkeypatch):
    source, given_texts = cached_encoder.CachedEncoder(WORDS), []
    encode = source.encode_chunks
    monkeypatch.setattr(source, "encode_chunks", lambda chunks: given_texts.extend(chunks) or encode(chunks))
    draw = random.Random(9)
    words = ["".join(draw.choices("thinger4", k=draw.randrange(1, 12))) for _ in range(5_000)]
    text = "".join(w + draw.choice([" ", "\n", " \t "]) for w in words)
    ids, offsets = source.encode(pa.array(["  ", text, ""], pa.large_string()))
    assert ids.tolist() == library(WORDS)(text) and offsets.tolist() == [0, 0, len(ids), len(ids)]
    assert len(given_texts) <= 5 and not any(c.isspace() for c in source.known)


def test_the_library_gets_many_words_behind_white_space_at_once(monkeypatch):
    source, given_texts = cached_encoder.CachedEncoder(BYTES), []
    encode = source.encode_chunks
    monkeypatch.setattr(source, "encode_chunks", lambda chunks: given_texts.extend(chunks) or encode(chunks))
    draw = random.Random(9)
    words = ["".join(draw.choices("thingerT4é日²", k=draw.randrange(1, 12))) for _ in range(5_000)]
    text = "".join(draw.choice([" ", " ", "\n", "\t"]) + w for w in words)
    ids, offsets = source.encode(pa.array(["", text, "  ", "a\u2003b <|endoftext|>"], pa.large_string()))
    assert ids[:offsets[2]].tolist() == library(BYTES)(text) and ids[offsets[2]:offsets[3]].tolist() == library(BYTES)("  ")
    assert ids[offsets[3]:].tolist() == library(BYTES)("a\u2003b <|endoftext|>")
    assert len(given_texts) <= 8


@pytest.mark.parametrize("path", [WORDS, BYTES])
def test_a_full_cache_keeps_the_chunks_of_the_texts_at_hand(monkeypatch, path):
    monkeypatch.setattr(cached_encoder, "REMEMBERED_BYTES", 0)
    source, given_texts = cached_encoder.CachedEncoder(path), []
    encode = source.encode_chunks
    monkeypatch.setattr(source, "encode_chunks", lambda chunks: given_texts.extend(chunks) or encode(chunks))
    for text, new in [
        ("the thing and one more", "the thing and one more"), ("the thing and one more", ""),
        ("the thing and two", "two"), ("and", "and" if path == BYTES else ""), ("  ", ""),
        ("the thing and one more", "the thing and one more"),
    ]:
        given_texts.clear()
        ids, _ = source.encode(pa.array([text], pa.large_string()))
        fresh = cached_encoder.CachedEncoder(path)
        assert ids.tolist() == fresh.encode(pa.array([text], pa.large_string()))[0].tolist() == library(path)(text)
        assert sorted(" ".join(given_texts).replace("~", " ").split()) == sorted(new.split())
        if text.strip():
            assert set(source.known) == set(fresh.known) and source.held_bytes == fresh.held_bytes


@pytest.mark.parametrize("special", ["ab", " ab", "a b", " ", "b\n"])
def test_special_tokens_of_words_behind_white_space(folder, special):
    from tokenizers import Tokenizer

    tokenizer, path = Tokenizer.from_file(BYTES), f"{folder}/special.json"
    tokenizer.add_special_tokens([special])
    tokenizer.save(path)
    texts = [" ab xaby", " a", " b\nc", " a b ab", " xa b\n"]
    source = cached_encoder.CachedEncoder(path)
    ids, offsets = source.encode(pa.array(texts, pa.large_string()))
    assert source.widths is None
    assert [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:])] == [library(path)(t) for t in texts]


@pytest.mark.parametrize("special", ["~", "ab", "a~b"])
def test_special_tokens_of_words_and_marks(folder, special):
    from tokenizers import Tokenizer

    tokenizer, path = Tokenizer.from_file(WORDS), f"{folder}/special.json"
    tokenizer.add_special_tokens([special])
    tokenizer.save(path)
    texts = ["ab ~ a~b", "a~", "xab~ y", "b c", "a b ab"]
    source = cached_encoder.CachedEncoder(path)
    ids, offsets = source.encode(pa.array(texts, pa.large_string()))
    assert source.mark is None
    assert [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:])] == [library(path)(t) for t in texts]


@settings(deadline=None, max_examples=150)
@given(texts=st.lists(TEXT, max_size=6))
def test_pieces_are_the_library(texts):
    codec, machine = piece_codec.codec(PIECES), token_counts.transducer(PIECES)
    column = pa.array(texts, pa.large_string())
    ids, offsets = codec.encode_texts(column)
    counts = machine.count(column)
    for k, text in enumerate(texts):
        expected = codec.model.library.encode(text)
        assert ids[offsets[k]:offsets[k + 1]].tolist() == expected and counts[k] == len(expected)


def test_transducer_composes_chunks():
    """Texts without a place of rest for several chunks, and the same cut at every length."""
    machine, draw = token_counts.transducer(PIECES), random.Random(3)
    texts = ["".join(draw.choice("thinger") for _ in range(n)) for n in (255, 256, 257, 2000)]
    encode = piece_codec.codec(PIECES).model.library.encode
    assert machine.count(pa.array(texts, pa.large_string())).tolist() == [len(encode(t)) for t in texts]


@settings(deadline=None, max_examples=60)
@given(width=st.integers(1, 32), count=st.integers(0, 300), seed=st.integers(0, 9))
def test_bit_packing_round_trip(width, count, seed):
    ids = np.random.default_rng(seed).integers(0, 1 << width, count).astype(np.uint32)
    stored = token_files.pack(ids, width)
    assert len(stored) == -(-count // 64) * 8 * width
    for first in (0, count // 2, max(count - 1, 0)):
        assert (token_files.unpack(stored, width, count - first, first) == ids[first:]).all()


def test_token_files(spark, folder, odd_docs, no_docs):
    token_files.write(odd_docs, f"{folder}/tokens", WORDS, end_id=1)
    segments = token_files.read(spark, f"{folder}/tokens")
    found = token_files.digests(segments).orderBy("start").collect()
    encode = library(WORDS)
    expected = collections.Counter((i, crc(encode(t) + [1])) for i, t in rows(odd_docs))
    assert collections.Counter((r.doc_id, r.ids_crc32) for r in found) == expected
    ids = [r.doc_id for r in found]
    assert ids == sorted(ids, key=lambda i: (i is not None, i or 0))
    assert [r.start for r in found] == np.cumsum([0] + [r.n_tokens for r in found])[:-1].tolist()
    assert sorted(map(list, token_files.tokens_of(segments, 13))) == [encode("x") + [1]]
    assert {crc(ids) for ids in token_files.tokens_of(segments, 5)} == {c for i, c in expected if i == 5}
    assert token_files.documents(segments).count() == odd_docs.count()
    token_files.write(no_docs, f"{folder}/none", WORDS, end_id=1)
    assert token_files.digests(token_files.read(spark, f"{folder}/none")).count() == 0


def test_packing(odd_docs, no_docs):
    found = packing.pack(odd_docs.withColumn("piece", F.lit("clash")), BYTES, end_id=2, capacity=64).collect()
    encode = library(BYTES)
    expected = collections.Counter(
        (i, k, s, n, crc(ids[s:s + n]))
        for i, ids in [(i, encode(t) + [2]) for i, t in rows(odd_docs)]
        for k, (s, n) in enumerate(packing.cut(len(ids), 64)))
    assert collections.Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found) == expected
    assert all(r.length == 64 or r.piece == 0 for r in found)
    sequences = collections.defaultdict(list)
    for r in found:
        sequences[r.sequence_id].append((r.offset, r.length))
    for places in sequences.values():
        ends = np.cumsum([n for _, n in sorted(places)])
        assert [o for o, _ in sorted(places)] == [0, *ends[:-1]] and ends[-1] <= 64
    assert packing.pack(no_docs, BYTES, end_id=2).count() == 0


def test_sum_of_squares_is_close_to_the_bound():
    lengths = np.random.default_rng(0).integers(1, 1024, 4000)
    sequence, _ = packing.sum_of_squares(lengths, 1024)
    used = np.bincount(sequence, lengths)
    assert used.max() <= 1024 and len(used) <= 1.02 * lengths.sum() / 1024
    assert len(packing.sum_of_squares(np.zeros(0, np.int64), 1024)[0]) == 0


def test_best_fit_needs_fewer_sequences_than_sum_of_squares():
    """The rule by itself, against a recount of the squares; and the placement that is used instead."""
    lengths = np.random.default_rng(1).integers(1, 30, 300)
    for decreasing in (True, False):
        sequence, offset = packing.sum_of_squares(lengths, 30, tight=False, decreasing=decreasing)
        left, squares = {}, lambda gaps: sum(n * n for g, n in collections.Counter(gaps.values()).items() if g)
        for at in np.argsort(-lengths, kind="stable") if decreasing else range(len(lengths)):
            size, chosen = int(lengths[at]), int(sequence[at])
            choices = {left.get(s, 30): s for s in [*left, len(left)] if left.get(s, 30) >= size}
            least = min(squares({**left, s: gap - size}) for gap, s in choices.items())
            assert offset[at] == 30 - left.get(chosen, 30)
            left[chosen] = left.get(chosen, 30) - size
            assert squares(left) == least
    lengths = np.random.default_rng(2).integers(1, 1024, 4000)
    used, by_length, as_drawn = (
        len(np.unique(packing.sum_of_squares(lengths, 1024, **how)[0]))
        for how in ({}, {"tight": False}, {"tight": False, "decreasing": False}))
    assert used <= by_length <= as_drawn


def test_piece_codec_and_counts(odd_docs, no_docs):
    processor = piece_codec.codec(PIECES).model.library
    found = collections.Counter(tuple(r) for r in piece_codec.round_trip(odd_docs, PIECES).collect())
    expected = collections.Counter()
    for i, t in rows(odd_docs):
        ids = [1, *processor.encode(t), 2]
        expected[(i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                  hashlib.sha256(processor.decode(ids).encode()).hexdigest())] += 1
    assert found == expected
    assert piece_codec.encoded(odd_docs, PIECES).where("size(ids) < 2").count() == 0
    counted = collections.Counter(tuple(r) for r in token_counts.count_tokens(odd_docs, PIECES).collect())
    assert counted == collections.Counter(
        (i, len(t.encode()), len(processor.encode(t)), len(processor.encode(t)) > 4096) for i, t in rows(odd_docs))
    assert piece_codec.round_trip(no_docs, PIECES).count() == token_counts.count_tokens(no_docs, PIECES).count() == 0


def test_quotient_filter_round_trip_and_merge():
    draw = np.random.default_rng(1)
    parts, total = [], collections.Counter()
    for _ in range(4):
        values = np.concatenate([draw.integers(0, 1 << 20, 500), [0, 0, 0, 1, (1 << 20) - 1]]).astype(np.uint64)
        distinct, counts = np.unique(values, return_counts=True)
        stored = exact_dedup.build_filter(distinct, counts, 20)
        back = exact_dedup.read_filter(stored, 20)
        assert (back[0] == distinct).all() and (back[1] == counts).all()
        parts.append(stored)
        total.update(values.tolist())
    values, counts = exact_dedup.read_filter(exact_dedup.merge_filters(parts, 20), 20)
    assert dict(zip(values.tolist(), counts.tolist())) == dict(total)
    # A count equal to the remainder it belongs to, and remainders that are zero.
    values, counts = np.array([0, 3, 4], np.uint64), np.array([7, 3, 4])
    back = exact_dedup.read_filter(exact_dedup.build_filter(values, counts, 4), 4)
    assert back[0].tolist() == [0, 3, 4] and back[1].tolist() == [7, 3, 4]


def test_exact_dedup(odd_docs, no_docs):
    docs = odd_docs.withColumn("fingerprint", F.lit("clash")).withColumn("_row", F.lit(1))
    found = exact_dedup.exact_groups(docs).collect()
    groups = collections.defaultdict(list)
    for i, t in rows(odd_docs):
        groups[hashlib.sha256(t.encode()).hexdigest()].append(i)
    assert len(found) == sum(map(len, groups.values()))
    for r in found:
        ids = [i for i in groups[r.text_sha256] if i is not None]
        assert r.group_size == len(groups[r.text_sha256]) and r.keep_id == (max(ids) if ids else None)
    assert sum(r.kept for r in found) == len(groups)
    kept = exact_dedup.keep_one(docs)
    assert kept.columns == docs.columns and kept.count() == len(groups)
    assert exact_dedup.exact_groups(no_docs).count() == exact_dedup.keep_one(no_docs).count() == 0


def test_near_dedup_against_brute_force(spark):
    draw = random.Random(5)
    texts = []
    for _ in range(12):
        words = [f"w{draw.randrange(400)}" for _ in range(draw.choice([3, 30, 120]))] * draw.choice([1, 1, 3])
        for _ in range(12):
            copy = list(words)
            for _ in range(draw.randrange(0, 5)):
                copy[draw.randrange(len(copy))] = f"x{draw.randrange(9)}"
            texts.append(" ".join(copy))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    bags = [collections.Counter(tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))) for w in map(str.split, texts)]
    sets = components.Sets()
    for a in range(len(bags)):
        for b in range(a):
            low = sum((bags[a] & bags[b]).values())
            if low >= 0.8 * (sum(bags[a].values()) + sum(bags[b].values()) - low):
                sets.join(a, b)
    found = {r.doc_id: r.class_id for r in near_dedup.near_classes(docs).collect()}
    assert found == {k: sets.find(k) for k in range(len(texts))}


def test_near_dedup_on_odd_rows(odd_docs, no_docs):
    kept = near_dedup.keep_one(odd_docs.withColumn("band", F.lit(0)))
    assert kept.count() == len({t for _, t in rows(odd_docs)}) and kept.columns[-1] == "band"
    assert near_dedup.near_classes(no_docs).count() == 0


def test_each_class_keeps_a_row_whatever_its_ids(spark):
    """Classes without ids, and classes that share their smallest id."""
    def copies(word, ids):
        words = [f"{word}{k}" for k in range(200)]
        return [(i, " ".join([*words, f"end{k}"])) for k, i in enumerate(ids)]

    groups = [copies("a", [None, None]), copies("b", [None, None, None]), copies("c", [4, 5]), copies("d", [6, 4])]
    docs = spark.createDataFrame(sum(groups, []), "doc_id long, text string")
    kept = [(r.doc_id, r.text[0]) for r in near_dedup.keep_one(docs).collect()]
    assert sorted(kept, key=str) == [(4, "c"), (4, "d"), (None, "a"), (None, "b")]
    found = near_dedup.near_classes(docs)
    assert sorted(r["count"] for r in found.groupBy("class_sha256").count().collect()) == [2, 2, 2, 3]


def test_blocks_of_a_large_bucket(spark, monkeypatch):
    """A chain: neighbours are alike, the leader is like few; blocks of three members."""
    monkeypatch.setattr(near_dedup, "BLOCK", 3)
    base = [f"w{k}" for k in range(300)]
    texts = [" ".join(base[4 * k:] + [f"t{j}" for j in range(4 * k)]) for k in range(24)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r.class_id for r in near_dedup.near_classes(docs).collect()} == {0}


def test_bagminhash_is_unbiased():
    draw = np.random.default_rng(2)
    value = np.sort(draw.integers(0, 2**63, 150).astype(np.uint64))
    a = draw.integers(1, 12, 150)
    b = np.maximum(a + draw.integers(-4, 4, 150), 1)
    found = bagminhash.signatures(np.repeat([0, 1], 150), np.tile(value, 2), np.concatenate([a, b]), 2, 8000)
    exact = np.minimum(a, b).sum() / np.maximum(a, b).sum()
    assert abs((found[0] == found[1]).mean() - exact) < 0.02


def test_components(spark):
    draw = random.Random(1)
    edges = [(draw.randrange(300), draw.randrange(300)) for _ in range(220)] + [(k, k + 1) for k in range(400, 460)]
    sets = components.Sets()
    for a, b in edges:
        sets.join(a, b)
    frame = spark.createDataFrame(edges, "x long, y long").repartition(7)
    found = {r.node: r.root for r in components.components(frame).collect()}
    assert all(found.get(n, n) == sets.find(n) for edge in edges for n in edge)
    assert components.components(spark.createDataFrame([], "x long, y long")).count() == 0


def test_multiset_hash(spark):
    a, b = "First line. It goes on.\nSecond line", "Third one is here. And more.\n\nLast"
    frame = spark.createDataFrame([(a, b, f"{a}\n{b}", "\n".join(reversed(a.split("\n"))))], "a string, b string, ab string, turned string")
    v = {n: multiset_hash.vector(F.col(n)) for n in frame.columns}
    row = frame.select(
        (multiset_hash.written(multiset_hash.added(v["a"], v["b"])) == multiset_hash.written(v["ab"])).alias("insert"),
        (multiset_hash.written(multiset_hash.removed(v["ab"], v["b"])) == multiset_hash.written(v["a"])).alias("delete"),
        (multiset_hash.written(v["turned"]) == multiset_hash.written(v["a"])).alias("order"),
        (multiset_hash.written(v["a"]) != multiset_hash.written(v["b"])).alias("other"),
        (multiset_hash.likeness(v["a"], v["ab"]) > multiset_hash.likeness(v["a"], v["b"])).alias("near")).first()
    assert all(row)


def test_edited_pairs(spark, odd_docs, no_docs, monkeypatch):
    monkeypatch.setattr(multiset_hash, "RANGE_ROWS", 3)
    docs = spark.createDataFrame([(3 * k + 1, f"text {k}. " * (k % 7)) for k in range(40)], "doc_id long, text string")
    found = {r.doc_id: r for r in multiset_hash.edited_pairs(docs.repartition(4)).collect()}
    listed = sorted(rows(docs))
    for k, (i, t) in enumerate(listed):
        half, following = len(t) // 2, listed[(k + 1) % len(listed)][1]
        edited = t[:len(t) - half] + following[:half]
        assert found[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest() and found[i].n_chars == len(t)
        assert 0 <= found[i].near_edited <= 1 and 0 <= found[i].near_next <= 1
    odd = multiset_hash.edited_pairs(odd_docs.withColumn("range", F.lit(0)))
    assert odd.count() == odd_docs.count()
    assert multiset_hash.edited_pairs(no_docs).count() == 0


def test_quality(spark, odd_docs, no_docs):
    data = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{data}/documents.parquet"), spark.read.parquet(f"{data}/labels.parquet")
    model = quality.fit(docs, labels)
    judged = quality.score(docs, model).join(labels, "doc_id").where("held_out").collect()
    right = sum(r.predicted == r.quality for r in judged)
    assert len(judged) > 50 and right >= 0.9 * len(judged)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in judged)
    odd = quality.score(odd_docs, model).collect()
    assert len(odd) == odd_docs.count() and all(0 <= r.score <= 1 for r in odd)
    kept = quality.keep_good(odd_docs.withColumn("score", F.lit("clash")), model)
    assert kept.columns[-1] == "score" and kept.count() == sum(r.predicted for r in odd)
    unlabelled = quality.fit(docs, labels.limit(0))
    assert {r.score for r in quality.score(odd_docs, unlabelled).collect()} == {1.0}
    assert quality.score(no_docs, model).count() == 0


def test_surrogates(spark, odd_docs, no_docs):
    text = ("Mr. John Smith and Frau Anna Weber met Господин Иван Петров; mail John.Smith@Example.com, "
            "john.smith@example.com or ann@example.com. Call +1 (337) 555-7349 or +1-337-555-7349, "
            "card 4003 0366 2664 9761 or 4003036626649761, host 24.243.215.198. "
            'key "F3EF4D6B2755A36D7D9C25BD72C4D5F67E061FDA", version 4.0.')
    docs = spark.createDataFrame([(1, text), (2, "plain text, version 2.0."), (3, text)], "doc_id long, text string")
    out = {r.doc_id: r for r in surrogates.replaced(docs, "key").collect()}
    new = out[1].text
    assert out[3].text == new and out[2].text == "plain text, version 2.0." and out[2].n_found == 0
    for gone in ("Smith", "Weber", "Петров", "ohn.", "337", "4003 0366", "24.243", "F3EF4D"):
        assert gone not in new
    import re

    mails = re.findall(r"[\w.]+@[\w.]+", new)
    assert len({m.lower().rstrip(".") for m in mails}) == 2
    assert len({m.lower().rstrip(".").split("@")[1] for m in mails}) == 1 and all(".com" in m for m in mails)
    phones = re.findall(r"\+1[ -]\(?\d{3}\)?[ -]\d{3}-\d{4}", new)
    assert len(phones) == 2 and len({re.sub(r"\D", "", p) for p in phones}) == 1
    cards = re.findall(r"4\d{3} \d{4} \d{4} \d{4}|4\d{15}", new)
    assert len(cards) == 2 and len({c.replace(" ", "") for c in cards}) == 1
    assert re.search(r'"[0-9A-F]{40}"', new) and re.search(r"Mr\. [A-Z][a-z]+ [A-Z][a-z]+ and Frau ", new)
    given_name = re.search(r"Mr\. (\w+)", new)[1]
    assert given_name in surrogates.GIVEN[("m", "latin")] and re.search("Господин [А-Я][а-я]+ [А-Я][а-я]+", new)
    odd = surrogates.replaced(odd_docs.withColumn("_key", F.lit(1)), "key")
    assert odd.count() == odd_docs.count() and odd.where("text IS NULL").count() == 2 and "_key" in odd.columns
    assert surrogates.replaced(no_docs, "key").count() == 0


def test_colliding_surrogates_are_drawn_again(spark, monkeypatch):
    real = surrogates.surrogate

    def narrow(kind, plain, attempt, key):
        """Two values only on the first attempt, one of them an entity of the corpus."""
        return F.when(attempt == 0, F.when(F.crc32(plain) % 2 == 0, F.lit("10.0.0.1")).otherwise(F.lit("9.9.9.9"))
                      ).otherwise(real(kind, plain, attempt, key))

    monkeypatch.setattr(surrogates, "surrogate", narrow)
    docs = spark.createDataFrame([(k, f"host 10.0.0.{k} here") for k in range(1, 30)], "doc_id long, text string")
    texts = [r.text for r in surrogates.replaced(docs, "key").collect()]
    assert len(set(texts)) == 29 and not {f"host 10.0.0.{k} here" for k in range(1, 30)} & set(texts)


def test_letters_of_other_scripts_and_used_up_forms(spark, monkeypatch):
    """Names without a Latin, Cyrillic or Greek letter; forms with as many entities as surrogates."""
    monkeypatch.setattr(surrogates, "ATTEMPTS", 2)
    names = ["Արամ", "Արամ Պետրոսյան", "𝐀𝐛𝐜", "ℂ𝐛"]
    mails = [f"{c}@example.com" for c in "0123456789"]
    phones = [f"+1 {k:02} {j:02}" for k in range(10, 20) for j in range(0, 100, 7)]
    mentions = [f"Mr. {n}" for n in names] + mails + phones
    docs = spark.createDataFrame([(k, f"see {m} now") for k, m in enumerate(mentions)], "doc_id long, text string")
    new = {r.doc_id: r.text[4:-4] for r in surrogates.replaced(docs, "key").collect()}
    assert len(new) == len(set(new.values())) == len(mentions) and not set(new.values()) & set(mentions)
    assert all("\u0531" <= c <= "\u0588" or c in " Mr." for k in (0, 1) for c in new[k])
    assert all(new[len(names) + k].endswith(".com") for k in range(10))
    # All two-letter names but few are entities.
    pairs = [a + b for a in "abcdefghijklmnopqrstuvwxyz" for b in "abcdefghijklmnopqrstuvwxyz"][:600]
    docs = spark.createDataFrame([(k, f"Ms {p.title()}") for k, p in enumerate(pairs)], "doc_id long, text string")
    new = [r.text for r in surrogates.replaced(docs, "key").collect()]
    assert len(set(new)) == 600 and not set(new) & {f"Ms {p.title()}" for p in pairs}


def test_url_templates(spark):
    urls = [None, "nothing", "HTTP://A.Net", "http://a.net/", "x://b.example.NET/en/1?q#f", "x://example.net/EN/1",
            "x://m.example.com/de/7.html", "x://q.org/fr/2", "x://exa.mple/p/1", "a://net.org/x"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    none = spark.createDataFrame([], "doc_id long, quality int")
    found = {r.page_id: r for r in url_templates.filter_urls(pages, none).collect()}
    assert len(found) == len(urls)
    assert [(found[k].host, found[k].path) for k in (0, 1, 2, 4)] == [
        ("", ""), ("", ""), ("a.net", ""), ("b.example.net", "/en/1")]
    assert [found[k].rule for k in range(10)] == [
        None, None, None, "net/", "example.net/en/", "net/", "example.com/de/", "org/fr/", None, None]
    assert [found[k].verdict for k in range(10)] == [
        "allow", "allow", "allow", "block", "allow", "block", "block", "allow", "allow", "allow"]
    assert url_templates.filter_urls(pages.limit(0), none).count() == 0


def test_url_templates_reject_bad_branches(spark):
    pages = [(k, f"http://site.info/{'spam' if k % 4 == 0 else 'news' if k % 4 == 1 else 'blog'}/{k}.html") for k in range(400)]
    labels = [(k, 0 if k % 4 == 0 else 1) for k in range(0, 400)]
    found = url_templates.filter_urls(
        spark.createDataFrame(pages, "page_id long, url string"),
        spark.createDataFrame(labels, "doc_id long, quality int")).collect()
    assert all((r.verdict == "block") == (r.page_id % 4 == 0) for r in found)
    assert len({r.template for r in found if r.page_id % 4}) == 1 or all(r.purity > 0.5 for r in found if r.page_id % 4)


def verdicts_of(spark, paths, bad):
    """Templates and verdicts of labelled pages of one host; the first part of a path says what it is."""
    found = url_templates.filter_urls(
        spark.createDataFrame([(k, f"http://site.info{p}/{k}") for k, p in enumerate(paths)], "page_id long, url string"),
        spark.createDataFrame([(k, int(not bad(p))) for k, p in enumerate(paths)], "doc_id long, quality int")).collect()
    return [(paths[r.page_id], r.template, r.verdict) for r in found]


@pytest.mark.parametrize("name", ["spam", "7"])
@pytest.mark.parametrize("size", [900, 3_000])
def test_a_large_branch_beside_many_small_ones_is_judged_alone(spark, name, size):
    letters = "abcdefghij"
    paths = ["/slug-" + "".join(letters[int(d)] for d in str(k)) for k in range(1_000)] + [f"/{name}"] * size
    found = verdicts_of(spark, paths, lambda p: p == f"/{name}")
    assert all((verdict == "block") == (path == f"/{name}") for path, _, verdict in found)
    assert len({template for path, template, _ in found if path != f"/{name}"}) == 1


def test_branches_that_part_at_a_deep_level_are_told_apart(spark):
    paths = [f"/a/b/c/d{'/e' * extra}/{kind}" for extra in (0, 1, 4) for kind in ("good", "bad") for _ in range(40)]
    found = verdicts_of(spark, paths, lambda p: p.endswith("bad"))
    assert len(found) == len(paths)
    assert all((verdict == "block") == path.endswith("bad") for path, _, verdict in found)


def test_no_window_over_the_pages_of_a_host(spark, monkeypatch):
    plans, real = [], url_templates.staged
    monkeypatch.setattr(url_templates, "staged", lambda frame, name: (
        plans.append(frame._jdf.queryExecution().toString()), real(frame, name))[1])
    verdicts_of(spark, ["/a/b", "/a/c", "/d"], lambda p: p == "/d")
    assert plans and not any("Window" in plan for plan in plans)
