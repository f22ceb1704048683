import random

import numpy as np
import pyarrow as pa
import pytest

from streammetrics.llm import bestfit, packing
from streammetrics.llm.tokens import ByteEncoder, WordEncoder

KINDS = [(WordEncoder, bestfit.default_tokenizer()), (ByteEncoder, packing.default_tokenizer())]


@pytest.mark.parametrize("kind,path", KINDS)
def test_random_texts_equal_whole_encoding(kind, path):
    coder = kind(path)
    rng = random.Random(17)
    parts = [" ", " ", " ", "\n", "\n", "\n\n", "  ", "\t", "\r\n", "　", "\xa0", "\x85", "\x1c", "\x01", "\0", "a", "Bc", "the", "İ", "ß",
             "é", "é", "́", "日本", "🦆", "12", "3", ".", ",", "(", ")", "!?", "--", "_", "'s", "'", "'ll", "<|endoftext|>", "<|", "|>"]
    texts = ["".join(rng.choice(parts[:rng.choice([6, 20, len(parts)])] + ["word", "w"]) for _ in range(rng.randint(0, 30)))
             for _ in range(6000)]
    for limit in (kind.LIMIT, 20):
        coder.LIMIT = limit
        for at in range(0, len(texts), 500):
            some = texts[at:at + 500]
            ids, bounds = coder.batch(pa.array([None, *some], pa.string()))
            assert bounds[0] == bounds[1] == 0
            for t, a, b in zip(some, bounds[1:], bounds[2:]):
                assert ids[a:b].tolist() == coder.tokenizer.encode(t, add_special_tokens=False).ids, repr(t)


@pytest.mark.parametrize("kind,path", KINDS)
def test_letters_and_punctuation_of_the_plain_path(kind, path):
    coder = kind(path)
    chars = [chr(c) for c in range(0x21, 0x250)]
    texts = [t for c in chars for t in (f"{c} x{c}\n{c}x x{c}x ({c}). \"{c}\"", f"{c}{c} a{c}b {c}12 12{c}")]
    ids, bounds = coder.batch(pa.array(texts, pa.string()))
    for t, a, b in zip(texts, bounds, bounds[1:]):
        assert ids[a:b].tolist() == coder.tokenizer.encode(t, add_special_tokens=False).ids, repr(t)


@pytest.mark.parametrize("kind,path", KINDS)
def test_no_texts_empty_texts_and_slices_of_arrays(kind, path):
    coder = kind(path)
    for texts in ([], [""], ["", None, ""]):
        ids, bounds = coder.batch(pa.array(texts, pa.string()))
        assert len(ids) == 0 and bounds.tolist() == [0] * (len(texts) + 1)
    whole = pa.array(["one two", "three, four", "five\nsix"], pa.string())
    ids, bounds = coder.batch(whole.slice(1, 2))
    want = [coder.tokenizer.encode(t, add_special_tokens=False).ids for t in ("three, four", "five\nsix")]
    assert [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])] == want


def test_tokenizers_of_real_texts(sf_dir):
    import pyarrow.parquet as pq
    texts = pq.read_table(f"{sf_dir}/documents.parquet")["text"].combine_chunks()
    for kind, path in KINDS:
        coder = kind(path)
        ids, bounds = coder.batch(texts)
        for t, a, b in zip(texts.to_pylist(), bounds, bounds[1:]):
            assert np.array_equal(ids[a:b], coder.tokenizer.encode(t or "", add_special_tokens=False).ids)
