"""What a worker holds while it tokenises."""

from pathlib import Path

import pyarrow as pa
import public_tokenizers

from nearstop.llm import packing


def test_few_texts_are_held_at_once():
    texts = pa.array(["a" * 400, None, "", "é" * 300, "b" * 100])
    runs = list(packing._groups(texts, 500))
    assert runs == [(0, ["a" * 400, "", "", "é" * 300]), (4, ["b" * 100])]
    assert list(packing._groups(pa.array([], pa.string()), 500)) == []


def test_the_cache_keeps_frequent_words_only(monkeypatch):
    spec = Path(public_tokenizers.path("word_bpe_49k.json")).read_text()
    encoder, plain = packing.Encoder(spec, True), packing.Encoder(spec, False)
    monkeypatch.setattr(packing, "CACHE", 60)
    monkeypatch.setattr(packing, "BATCH", 7)
    for run in range(20):
        texts = ["often " + " ".join(f"rare{run}x{n}, word" for n in range(20)), "", "Ünusual 一 <|x"]
        assert list(encoder.encode(texts)) == list(plain.encode(texts))
        assert len(encoder.cache) <= 60 and "often" in encoder.cache
