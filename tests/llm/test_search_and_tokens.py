"""Decontamination, packing and the token store against brute force."""

import random
import re
import sys
import tracemalloc
import zlib

import numpy as np
import pytest
from tokenizers import AddedToken, Tokenizer

from strata.llm import decontaminate, packing, token_store, tokens
from strata.llm.tokens import Encoder, tokenizer_path
from tests.llm import brute
from tests.llm.conftest import EDGE_TEXTS


def benchmark_case():
    rng = random.Random(2)
    words = [f"t{i}" for i in range(60)] + ["Über", "naïve"]
    items = [(f"i{k}", " ".join(rng.choices(words, k=rng.choice([1, 3, 9, 10, 11, 40])))) for k in range(25)]
    items += [("dup", items[3][1]), (None, "null id item text"), ("none", None), ("blank", " .. "), ("dup", items[3][1])]
    texts = [*EDGE_TEXTS]
    for _ in range(60):
        text = rng.choices(words, k=rng.randrange(0, 300))
        if rng.random() < 0.5:
            cut = (rng.choice(items)[1] or "").split()
            at = rng.randrange(len(text) + 1)
            text[at:at] = [w.upper() + rng.choice(["", ",", "!"]) for w in cut]
        texts.append(" ".join(text))
    return texts, items


@pytest.mark.parametrize("block_bytes", [1_000_000, 400])
def test_windows_are_found_like_brute_force(docs, spark, block_bytes):
    texts, items = benchmark_case()
    frame = docs(texts, extra=True)
    table = spark.createDataFrame(items, "item_id string, text string")
    found = decontaminate.find_contamination(frame, table, block_bytes=block_bytes)
    wanted = brute.contamination(dict(enumerate(texts)), items)
    got = {r.doc_id: (r.n_words, sum(s.end - s.start for s in r.hit_spans), sorted(r.hit_items)) for r in found.collect()}
    assert got == wanted and any(hits for _, hits, _ in wanted.values())
    clean = decontaminate.remove_contaminated(frame, table)
    assert clean.columns == frame.columns
    assert sorted(r.doc_id for r in clean.collect()) == sorted(k for k, v in wanted.items() if not v[1])
    none = decontaminate.find_contamination(frame, table.limit(0)).collect()
    assert all(not r.hit_items and not r.hit_spans for r in none)
    assert decontaminate.find_contamination(frame.limit(0), table).collect() == []


TOKENIZER = Tokenizer.from_file(tokenizer_path())
PARTS = ["a", "Word", " ", "  ", "\n", "\t", "é", "ß", "12", "'s", "!", "..", "\x1c", "\x85", "\xa0", "　", "語", "🎉", "\r\n", "x y"]


def ids_of(text):
    return np.array([*(TOKENIZER.encode(text, add_special_tokens=False).ids if text else []), 0], "<u4")


def test_many_items_that_end_alike_need_little_memory():
    rng = random.Random(8)
    items = [(f"i{k}", " ".join(f"v{rng.randrange(5000)}" for _ in range(8)) + " the end") for k in range(4000)]
    texts = ["so it is the end " * 20_000, f"well {items[7][1]} {items[9][1]}"]
    matcher = decontaminate.Matcher(items)
    tracemalloc.start()
    found = matcher.scan(texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found[0][2] == set() and found[1][2] == {"i7", "i9"} and found[1][1] == [(1, 21)]
    assert peak < 60_000_000


def test_compiling_a_benchmark_needs_memory_in_proportion():
    rng = random.Random(9)
    items = [(f"i{k}", " ".join(f"v{rng.randrange(3000)}" for _ in range(400))) for k in range(500)]
    tracemalloc.start()
    given = [*items, *items]
    matcher = decontaminate.Matcher(given)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 40 * sum(len(text) for _, text in given)
    assert [hit for _, _, hit in matcher.scan([items[3][1], "nothing"])] == [{"i3"}, set()]


def test_encoder_equals_the_library():
    rng = random.Random(1)
    texts = ["".join(rng.choices(PARTS, k=rng.randrange(0, 40))) for _ in range(3000)] + EDGE_TEXTS
    for limit in (400_000, 50):
        encode = Encoder(tokenizer_path(), limit=limit).encode
        for i in range(0, len(texts), 500):
            ids, starts = encode(texts[i:i + 500])
            for k, text in enumerate(texts[i:i + 500]):
                assert ids[starts[k]:starts[k + 1]].tolist() == ids_of(text).tolist()


def test_all_white_space_but_blanks_and_line_ends_is_rare():
    assert tokens._RARE == [chr(i) for i in range(sys.maxunicode + 1) if re.fullmatch(r"[^\S \n]", chr(i))]
    assert not any(Encoder(tokenizer_path()).regular(f"a b{letter}c d") for letter in tokens._RARE)


def test_added_tokens_have_their_ids_as_in_the_library(docs, spark):
    rng = random.Random(4)
    parts = [*PARTS, *["<|endoftext|>"] * 4, "<|endoftext", "|>", "<|"]
    texts = ["a <|endoftext|> b", "<|endoftext|>", *("".join(rng.choices(parts, k=rng.randrange(0, 40))) for _ in range(1000))]
    for limit in (400_000, 50):
        encode = Encoder(tokenizer_path(), limit=limit).encode
        for i in range(0, len(texts), 200):
            ids, starts = encode(texts[i:i + 200])
            for k, text in enumerate(texts[i:i + 200]):
                assert ids[starts[k]:starts[k + 1]].tolist() == ids_of(text).tolist()
    few = texts[:60]
    store = token_store.write_store(docs(few), docs_per_shard=9)
    read = {r.doc_id: r.ids for r in token_store.read_keys(spark, store, token_store.all_keys(docs(few))).collect()}
    assert read == {i: ids_of(t).tobytes() for i, t in enumerate(few)}
    packed = {r.doc_id: r.doc_tokens for r in packing.pack(docs(few)).collect()}
    assert packed == {i: len(ids_of(t)) for i, t in enumerate(few)}


def test_added_tokens_that_take_in_blanks_are_left_to_the_library(tmp_path):
    path = str(tmp_path / "tokenizer.json")
    library = Tokenizer.from_file(tokenizer_path())
    library.add_special_tokens([AddedToken("<pad>", lstrip=True, rstrip=True)])
    library.save(path)
    texts = ["a  <pad>  b", "c <|endoftext|> d", "plain text", "<pad>"]
    ids, starts = Encoder(path).encode(texts)
    for k, text in enumerate(texts):
        assert ids[starts[k]:starts[k + 1]].tolist() == [*library.encode(text, add_special_tokens=False).ids, 0]


def test_added_tokens_with_blanks_do_not_arise_between_texts(tmp_path):
    path = str(tmp_path / "tokenizer.json")
    library = Tokenizer.from_file(tokenizer_path())
    library.add_special_tokens([AddedToken("quick brown")])
    library.save(path)
    texts = ["a quick test", "a brown test", "the quick brown fox", "quick", "brown quick"]
    ids, starts = Encoder(path).encode(texts)
    for k, text in enumerate(texts):
        assert ids[starts[k]:starts[k + 1]].tolist() == [*library.encode(text, add_special_tokens=False).ids, 0]


def test_a_long_text_of_different_chunks_is_encoded_in_groups(monkeypatch):
    monkeypatch.setattr(tokens, "_WAITING", 50)
    text = " ".join(f"w{i} {'é' * (i % 5)}x{i},\ny{i}" for i in range(2000)) + "  end \t"
    for limit in (400_000, 50):
        encode = Encoder(tokenizer_path(), limit=limit).encode
        for _ in range(2):
            ids, _ = encode([text, " ", "a " + "b" * 300])
            assert ids.tolist() == [i for t in (text, " ", "a " + "b" * 300) for i in ids_of(t).tolist()]


class Counting:
    """The library, which keeps the texts it encodes together."""

    def __init__(self, library):
        self.library, self.texts = library, []

    def encode_batch_fast(self, texts, **more):
        self.texts.extend(texts)
        return self.library.encode_batch_fast(texts, **more)


def test_new_chunks_of_all_texts_are_encoded_together_and_much_used_ones_stay():
    encoder = Encoder(tokenizer_path(), limit=60)
    encoder.library = counting = Counting(encoder.library)
    for turn in range(6):
        texts = [f"first{turn}x{i} often used new{turn}x{i} often" for i in range(40)]
        ids, starts = encoder.encode(texts)
        for k, text in enumerate(texts):
            assert ids[starts[k]:starts[k + 1]].tolist() == ids_of(text).tolist()
    assert len(counting.texts) == 6
    assert sum(text.split().count("often") for text in counting.texts) == 1


def token_texts():
    rng = random.Random(6)
    return [*EDGE_TEXTS, *["".join(rng.choices(PARTS, k=rng.randrange(1, 4000))) for _ in range(40)]]


def test_pieces_hold_every_id_once_with_little_padding(docs):
    texts = token_texts()
    ids = {i: ids_of(t) for i, t in enumerate(texts)}
    rows = packing.pack(docs(texts, extra=True).repartition(3), block=16, with_ids=True).collect()
    covered, sequences = {i: 0 for i in ids}, {}
    for r in rows:
        piece = ids[r.doc_id][r.start:r.start + r.length]
        assert r.ids == piece.tobytes() and r.ids_crc32 == zlib.crc32(r.ids) and r.doc_tokens == len(ids[r.doc_id])
        covered[r.doc_id] += r.length
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert covered == {i: len(x) for i, x in ids.items()}
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= packing.SEQUENCE
    full = sum(covered.values())
    assert len(sequences) <= full // packing.SEQUENCE + 3 * (len(texts) // 16 + 2)
    assert packing.pack(docs([]).limit(0)).collect() == []


def test_balance_goes_to_the_cheapest_sequence_with_room():
    lengths = [700, 600, 500, 400, 300, 20, 10, 5]
    placed = packing.balance(lengths, 1024)
    cost, room = [0.0] * 3, [1024] * 3
    for piece, cut, size, target, offset in placed:
        rest = lengths[piece] - cut
        fits = [s for s in range(3) if room[s] >= rest] or [s for s in range(3) if room[s]]
        assert target == min(fits, key=lambda s: (cost[s], s)) and offset == 1024 - room[target]
        room[target] -= size
        cost[target] += size + size * size / 512
    assert sum(size for _, _, size, _, _ in placed) == sum(lengths)


def test_store_returns_what_was_written(docs, spark):
    texts = token_texts()
    rows = [(1000 - 3 * i, t) for i, t in enumerate(texts)] + [(None, "nobody"), (7, "twice"), (7, "again")]
    store = token_store.write_store(docs(rows, extra=True), docs_per_shard=9)
    read = token_store.read_keys(spark, store, token_store.all_keys(docs(rows)))
    found = sorted(read.collect(), key=lambda r: r.start)
    assert [r.doc_id for r in found] == [None, *sorted(k for k, _ in rows if k is not None)]
    at = 0
    for r in found:
        options = [ids_of(t).tobytes() for k, t in rows if k == r.doc_id]
        assert r.start == at and r.ids in options and r.n_tokens * 4 == len(r.ids)
        at += r.n_tokens
    asked = spark.createDataFrame([(5_000_000, 0), (7, 1), (7, 9)], "doc_id long, ordinal int")
    assert [(r.doc_id, r.ordinal) for r in token_store.read_keys(spark, store, asked, digest=True).collect()] == [(7, 1)]
    empty = token_store.write_store(docs([]).limit(0))
    assert token_store.read_keys(spark, empty, asked).collect() == []


def test_perfect_hash_is_minimal_and_survives_storage():
    keys = token_store.mix(np.arange(20_000, dtype=np.uint64))
    hashed = token_store.PerfectHash(keys)
    assert np.array_equal(np.sort(hashed(keys)), np.arange(len(keys)))
    assert np.array_equal(token_store.PerfectHash.load(hashed.dump())(keys), hashed(keys))
