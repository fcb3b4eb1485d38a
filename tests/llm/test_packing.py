import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from helpers import awkward, docs, empty
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from variantflow.llm import packing
from variantflow.llm.packing import Tokens, fill, pack, pack_group

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def plain():
    return Tokenizer.from_file(PATH)


def ids_of(tokens, texts):
    raw = [t.encode() for t in texts]
    offsets = np.cumsum([0] + [len(r) for r in raw])
    ids, first = tokens(np.frombuffer(b"".join(raw), np.uint8), offsets)
    return [ids[a:b].tolist() for a, b in zip(first[:-1], first[1:])]


PIECES = ["the", " ", "  ", "\n", "\t", " a", "é", " é", " ", "　", "  ", "x.", "'s", "12", " 12", "!!", "<|endoftext|>", "ñ ", "\x85", "日本", "🙂", "\x00"]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.sampled_from(PIECES), max_size=12), min_size=1, max_size=8))
def test_cached_pieces_give_the_tokenizers_ids(plain, made):
    texts = ["".join(x) for x in made]
    tokens = Tokens(PATH, cache=30)
    for _ in range(2):
        assert ids_of(tokens, texts) == [plain.encode(t, add_special_tokens=False).ids for t in texts]


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 30), st.integers(1, 4), max_size=8), st.integers(0, 60))
def test_fill_is_the_best_subset_sum(counts, space):
    order = sorted((x for x in counts if x <= space), reverse=True)
    sums = {0}
    for x in order:
        sums = {s + k * x for s in sums for k in range(counts[x] + 1) if s + k * x <= space}
    taken = fill(counts, order, space)
    assert all(0 < n <= counts[x] for x, n in taken.items())
    assert sum(x * n for x, n in taken.items()) == max(sums)


@pytest.mark.parametrize("seed", range(5))
def test_groups_have_no_padding(seed):
    rng = random.Random(seed)
    pieces = [(i, rng.randint(1, 63)) for i in range(rng.randint(0, 200))]
    seen = {i: [] for i, _ in pieces}
    for sequence in pack_group(pieces, 64):
        total = sum(x[2] for x in sequence)
        assert total <= 64 and total & (total - 1) == 0
        for i, start, length in sequence:
            seen[i].append((start, length))
    for i, length in pieces:
        at = 0
        for start, part in sorted(seen[i]):
            assert start == at
            at += part
        assert at == length


@pytest.mark.parametrize("group", [20_000, 3])
def test_every_id_is_in_one_piece(spark, plain, group):
    df = awkward(spark)
    rows = pack(df, group=group, capacity=256).collect()
    want = sorted((str(r.doc_id), plain.encode(r.text or "", add_special_tokens=False).ids + [1]) for r in df.where("doc_id <> 1").collect())
    by_doc = {}
    for r in rows:
        by_doc.setdefault(str(r.doc_id), []).append(r)
    got = []
    for key, pieces in by_doc.items():
        if key in ("None", "1"):
            continue
        pieces.sort(key=lambda r: r.start)
        ids = [i for r in pieces for i in np.frombuffer(r.ids, "<u4").tolist()]
        assert all(r.doc_tokens == len(ids) and r.length * 4 == len(r.ids) for r in pieces)
        got.append((key, ids))
    assert sorted(got) == want
    assert sum(r.length for r in by_doc["1"]) == 2 * by_doc["1"][0].doc_tokens
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 256
    assert pack(empty(spark)).collect() == []


def test_null_is_the_end_id(spark):
    r = pack(docs(spark, [(1, None, None, None)])).collect()
    assert [(x.doc_id, x.start, x.length, x.doc_tokens, x.offset) for x in r] == [(1, 0, 1, 1, 0)]


def test_strings_of_special_tokens(plain):
    """Special tokens by default, as the tokenizer has it; ordinary text if wanted."""
    texts = ["some text <|endoftext|> more words", "x  <|endoftext|><|endoftext|>  y", " <|endoftext|>", "a<|endoftext|"]
    assert ids_of(Tokens(PATH), texts) == [plain.encode(t, add_special_tokens=False).ids for t in texts]
    assert 50256 in ids_of(Tokens(PATH), texts)[0]
    text = Tokenizer.from_file(PATH)
    text.encode_special_tokens = True
    assert ids_of(Tokens(PATH, special_is_text=True), texts) == [text.encode(t, add_special_tokens=False).ids for t in texts]


@pytest.mark.parametrize("end_id", [1, 70_000])
def test_batches_are_small_whatever_a_task_holds(plain, end_id):
    """What remains of many documents leaves a task in rows of some megabytes, not at once."""
    texts = ["the" + " old house" * (500 + i % 400) for i in range(4000)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(4000), pa.int64()), pa.array(texts)], names=["key", "text"])
    made = list(packing._pack_batches(PATH, 2048, end_id, 20_000, False)(iter([batch])))
    assert sum(b.nbytes for b in made) > 20e6
    assert max(b.nbytes for b in made) < 6e6
    rows = [r for b in made for r in b.to_pylist()]
    ids = {}
    for r in sorted(rows, key=lambda r: (r["key"], r["start"])):
        ids[r["key"]] = ids.get(r["key"], []) + np.frombuffer(r["ids"], "<u4").tolist()
    assert ids == {i: x.ids + [end_id] for i, x in enumerate(plain.encode_batch(texts, add_special_tokens=False))}


def test_new_pieces_are_tokenised_in_parts(plain):
    """A slice of new words goes to the tokenizer in parts, whose ids are those of the whole texts."""
    texts = [" ".join(f"word{i * 5000 + k}" for k in range(5000)) + "  \n" for i in range(20)]
    tokens = Tokens(PATH)
    encode, most = tokens._encode, []
    tokens._encode = lambda parts: most.append(sum(map(len, parts))) or encode(parts)
    assert ids_of(tokens, texts) == [plain.encode(t, add_special_tokens=False).ids for t in texts]
    assert sum(most) > 900_000 and max(most) < 300_000


@pytest.mark.parametrize("seed", range(20))
def test_parts_of_a_few_bytes_give_the_tokenizers_ids(plain, seed, monkeypatch):
    monkeypatch.setattr(packing, "PART_BYTES", 8)
    rng = random.Random(seed)
    texts = ["".join(rng.choices(PIECES, k=rng.randrange(40))) for _ in range(8)]
    assert ids_of(Tokens(PATH, cache=30), texts) == [plain.encode(t, add_special_tokens=False).ids for t in texts]
