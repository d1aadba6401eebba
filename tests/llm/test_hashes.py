"""Range hashes against plain integers, on strings made to break polynomials modulo 2**64, and rows that share an id."""

import hashlib
import zlib
from collections import Counter

import brute
import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from ledgerframe.llm import block_dedup, jaccard_join, suffix_dedup, textops, token_file
from ledgerframe.llm.store import Scratch

#: Letters by the parity of the ones in their place: under these, polynomials modulo 2**64 are alike for any base.
EVEN = "".join("ab"[k.bit_count() % 2] for k in range(2048))
ODD = EVEN.translate(str.maketrans("ab", "ba"))


@given(st.lists(st.integers(0, (1 << 61) - 2), min_size=1, max_size=5), st.integers(0, (1 << 61) - 2))
@settings(max_examples=200, deadline=None)
def test_products(a, b):
    got = textops.times(np.array(a, np.uint64), np.full(1, b, np.uint64))
    assert got.tolist() == [x * b % textops.PRIME for x in a]


@pytest.mark.parametrize("which", [0, 1])
@pytest.mark.parametrize("kind", [np.uint8, np.uint64])
def test_ranges(which, kind, monkeypatch):
    rng = np.random.default_rng(5)
    values = rng.integers(0, 256, 300).astype(np.uint8) if kind is np.uint8 else rng.integers(0, 1 << 63, 300, dtype=np.uint64) * np.uint64(2)
    values[100:140] = values[:40]
    sums = textops.prefix_sums(values, which)
    a, b = np.array([0, 100, 0, 101, 7, 7]), np.array([40, 140, 41, 141, 7, 300])
    plain = [sum((int(v) + (kind is np.uint8)) * pow(textops._BASES[which], k, textops.PRIME) for k, v in enumerate(values[x:y])) % textops.PRIME for x, y in zip(a, b)]
    got = textops.range_hash(sums, a, b)
    assert got.tolist() == textops.mix(np.array(plain, np.uint64)).tolist() and got[0] == got[1] != got[2]
    monkeypatch.setattr(textops, "_POWERS", {})
    monkeypatch.setattr(textops, "SLICE_BYTES", -4000)
    assert textops.range_hash(textops.prefix_sums(values, which), a, b).tolist() == got.tolist()


def test_pieces_with_one_hash(monkeypatch):
    """Where the first hash of two pieces is the same, the second tells them apart, within a slice and between slices."""
    with open(public_tokenizers.path("byte_bpe_50k.json"), "rb") as f:
        encoder = token_file.Encoder(f.read())
    texts = ["some words here", "other words there", "the same words here"]

    def ids(*some):
        data = "".join(some).encode()
        offsets = np.concatenate(([0], np.cumsum([len(t.encode()) for t in some])))
        found, before = encoder.encode(np.frombuffer(data, np.uint8), offsets)
        return [found[a:b].tolist() for a, b in zip(before, before[1:])]

    want = [encoder.model.encode(t, add_special_tokens=False).ids for t in texts]
    assert ids(*texts) == want
    encoder.clear()
    monkeypatch.setattr(token_file.T, "bytes_hashes", lambda data, starts, ends, which=0: np.full(len(starts), 7, np.uint64))
    assert ids(*texts) == want and [x for t in texts for x in ids(t)] == want


def _encoded(encoder, texts):
    data = "".join(texts).encode()
    offsets = np.concatenate(([0], np.cumsum([len(t.encode()) for t in texts])))
    found, before = encoder.encode(np.frombuffer(data, np.uint8), offsets)
    return [found[a:b].tolist() for a, b in zip(before, before[1:])]


def test_new_pieces_in_rows():
    """Pieces that were not met are handed to the model many in a row; where the bytes don't tell where one ends, one by one."""
    with open(public_tokenizers.path("byte_bpe_50k.json"), "rb") as f:
        encoder = token_file.Encoder(f.read())

    class Counted:
        def __init__(self, model):
            self.model, self.texts = model, 0

        def encode_batch_fast(self, texts, **kwargs):
            self.texts += len(texts)
            return self.model.encode_batch_fast(texts, **kwargs)

    texts = [" ".join(f"w{k * k}x" for k in range(1000)), "", "Ünd  two\n\nlines fin\u00e9 d\u00e9j\u00e0 vu <|endoftext|> (x) "]
    want = [encoder.model.encode(t, add_special_tokens=False).ids for t in texts]
    encoder.model = Counted(encoder.model)
    assert _encoded(encoder, texts) == want and encoder.model.texts < 40
    handed = encoder.model.texts
    assert _encoded(encoder, texts[::-1]) == want[::-1] and encoder.model.texts == handed
    encoder.clear()
    encoder.width = encoder.width + 1
    assert _encoded(encoder, texts) == want and encoder.model.texts > 1000


def test_signs_among_latin_letters():
    """Punctuation after a multiplication or division sign belongs to the same run of signs."""
    with open(public_tokenizers.path("byte_bpe_50k.json"), "rb") as f:
        encoder = token_file.Encoder(f.read())
    some = [" ", "  ", "\n", "a", "B", "\u00e9", "\u00d7", "\u00f7", ".", "!", "'s", "'", "1", "<|", "<|endoftext|>", "\u65e5", "\u3000", "\u0301", "$", "\x00"]
    rng = np.random.default_rng(7)
    texts = ["\u00d7's", "a\u00f7... b"] + ["".join(rng.choice(some, rng.integers(0, 14))) for _ in range(600)]
    want = [encoder.model.encode(t, add_special_tokens=False).ids for t in texts]
    assert _encoded(encoder, texts) == want
    encoder.clear()
    assert [_encoded(encoder, [t])[0] for t in texts] == want


@pytest.mark.parametrize("hashed", [textops.bytes_hashes, textops.quick_words])
def test_words_by_slices(hashed, monkeypatch):
    data = np.random.default_rng(2).integers(97, 122, 5000).astype(np.uint8)
    cuts = np.unique(np.random.default_rng(3).integers(0, 5000, 300))
    whole = hashed(data, cuts[:-1], cuts[1:])
    monkeypatch.setattr(textops, "SLICE_BYTES", 100)
    assert np.array_equal(hashed(data, cuts[:-1], cuts[1:]), whole)


def test_patterned_strings():
    for n in (1024, 2048):
        both = np.frombuffer((EVEN[:n] + ODD[:n]).encode(), np.uint8)
        for which in (0, 1):
            h = textops.bytes_hashes(both, np.array([0, n]), np.array([n, 2 * n]), which)
            assert h[0] != h[1]


def test_patterned_words(spark):
    """Different long words are different words to all operators that know words or strings by hash."""
    a = " ".join([EVEN[:1024]] + [f"w{k}" for k in range(25)])
    b = " ".join([ODD[:1024]] + [f"w{k}" for k in range(25)])
    df = spark.createDataFrame([(1, EVEN + " " + "x" * 30), (2, ODD + " " + "y" * 30), (3, a), (4, b)], "doc_id long, text string")
    docs = [(r.doc_id, r.text) for r in df.collect()]
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.jaccard_components(df, shingle=4, threshold=(85, 100)).collect()} == brute.components(docs, 4, 85, 100)
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in block_dedup.remove_repeats(df).collect()} == brute.window_repeats(docs)
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.remove_repeats(df).collect()} == brute.byte_repeats(docs)
    path = Scratch(spark, "test").path("ids")
    token_file.write_tokens(df.coalesce(1), path, public_tokenizers.path("byte_bpe_50k.json"))
    model = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got = {r.doc_id: r.ids_crc32 for r in token_file.read_documents(spark, path).collect()}
    assert got == {d: zlib.crc32(np.array([*model.encode(t, add_special_tokens=False).ids, 0], "<u4").tobytes()) for d, t in docs}


def rows_of_ids():
    """Long, short, null and equal texts under the same ids."""
    long = " ".join(f"w{k * k % 997}" for k in range(1200))
    other = " ".join(f"v{k * k % 991}" for k in range(900))
    return [(5, long), (5, "short text " * 5), (6, long), (5, None), (5, other), (3, other[50:]), (3, other[50:]), (7, "x"), (7, ""), (7, long[:900] + " end"), (None, long), (8, other[:700] + long[-700:]), (8, long[:400])]


def test_byte_repeats_of_rows(spark):
    docs = rows_of_ids()
    got = Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.remove_repeats(spark.createDataFrame(docs, "doc_id long, text string")).collect())
    known = dict(enumerate(docs))
    plain = brute.byte_repeats([(k, t) for k, (d, t) in known.items() if d is not None])
    want = Counter((known[k][0], *v) for k, v in plain.items())
    raw = docs[0][1].encode()
    want[None, len(raw), 0, 0, hashlib.sha256(raw).hexdigest()] += 1
    assert got == want


def test_window_repeats_of_rows(spark):
    """Rows of one id are ordered by the digest of their texts; rows that repeat both stay."""
    docs = rows_of_ids()
    got = Counter((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in block_dedup.remove_repeats(spark.createDataFrame(docs, "doc_id long, text string")).collect())
    key = lambda d, t: (d, int(hashlib.md5((t or "").encode()).hexdigest()[:15], 16))
    plain = brute.window_repeats({key(d, t): t for d, t in docs if d is not None}.items())
    want = Counter((d, *plain[key(d, t)]) for d, t in docs if d is not None)
    want[None, len(brute.words(docs[0][1])), 0, hashlib.sha256(docs[0][1].encode()).hexdigest()] += 1
    assert got == want


def test_first_window_by_id(spark):
    """A copy is removed wherever it stands, though its id has another text as well."""
    w, x = " ".join(f"a{k}" for k in range(40)), " ".join(f"b{k}" for k in range(40))
    got = sorted((r.doc_id, r.n_removed) for r in block_dedup.remove_repeats(spark.createDataFrame([(3, w), (5, w), (5, x)], "doc_id long, text string")).collect())
    assert got == [(3, 0), (5, 0), (5, 40)]
