from array import array

import public_tokenizers
import pyarrow as pa
from tokenizers import Tokenizer

from tests.llm.conftest import ODD_TEXTS
from tidematch.llm import bpe, common

PATH = public_tokenizers.path("word_bpe_49k.json")
TEXTS = ODD_TEXTS[1:] + [
    "<|startoftext|>Hello<|endoftext|> x<|endoftext|>y <|nothing|>",
    "don't we'll they've İSTANBUL ΣΑΣ ΟΔΥΣΣΕΥΣ é ½ ４５６",
    "aaaaaaaaaaaaaaaa bababababa ααααα",
    "👩‍👩‍👧 zero​width \x00\x07     日本語 テスト 123",
    "x" * 5000,
]


def test_ids_and_text_equal_the_library():
    tokenizer = Tokenizer.from_file(PATH)
    decoder = bpe.Decoder(PATH)
    for text, packed in zip(TEXTS, bpe.Codec(PATH).encode(TEXTS)):
        ids = tokenizer.encode(text, add_special_tokens=False).ids
        assert list(array("I", packed)) == ids
        assert decoder.decode(packed) == tokenizer.decode(ids, skip_special_tokens=False)


def test_a_small_memory_changes_nothing(monkeypatch):
    whole = bpe.Codec(PATH).encode(TEXTS)
    monkeypatch.setattr(bpe, "REMEMBERED", 5)
    monkeypatch.setattr(bpe, "SLAB", 3)
    coder = bpe.Codec(PATH)
    assert coder.encode(TEXTS) == whole
    monkeypatch.setattr(bpe, "REMEMBERED_BYTES", 10)
    coder = bpe.Codec(PATH)
    assert [coder.encode([t])[0] for t in TEXTS] == whole


def test_rows(odd_docs):
    coded = bpe.decode(bpe.encode(odd_docs, PATH), PATH)
    rows = coded.collect()
    assert len(rows) == len(ODD_TEXTS)
    assert all(len(r["ids"]) == 4 * r["n_tokens"] for r in rows)
    assert [r["n_tokens"] for r in rows if r["doc_id"] in (0, 1)] == [0, 0]
    assert bpe.encode(odd_docs.limit(0), PATH).count() == 0
    again = bpe.recode(odd_docs, PATH)
    assert sorted(map(repr, again.collect())) == sorted(map(repr, rows))
    assert bpe.recode(odd_docs.limit(0), PATH).count() == 0


def test_parts_hold_every_row(monkeypatch):
    monkeypatch.setattr(common, "BYTES_OUT", 4)
    batch = pa.RecordBatch.from_pydict({"k": list(range(6)), "t": ["", None, "abcdefgh", "ab", "cd", "e"]})
    assert list(common._parts(batch, 500)) == [(0, 2), (2, 3), (3, 5), (5, 6)]
    assert list(common._parts(batch, 1)) == [(k, k + 1) for k in range(6)]
    assert list(common._parts(batch.slice(0, 0), 5)) == []
