"""Variable-capacity bins over token ids: the packed sequences give every text back."""

import numpy as np
import tiktoken

from cohortwise.llm import packing, tokens


def texts():
    words = "alpha beta gamma delta epsilon zeta été 漢字 #$% \n".split(" ")
    rng = np.random.default_rng(8)
    rows = [(i, " ".join(rng.choice(words, int(rng.integers(0, 900))))) for i in range(90)]
    rows += [(90, None), (91, ""), (92, "x" * 9000), (5, rows[5][1]), (5, rows[5][1]), (None, "no id"), (None, None)]
    return [(i, t, "clash", 7) for i, t in rows]


def whole(rows):
    """The texts' token ids put together again from the segments, by document id."""
    pieces = {}
    for r in rows:
        ends = list(r.cu_seqlens)
        assert ends[0] == 0 and ends[-1] == r.n_tokens == len(r.ids) <= r.bin_capacity
        for j, (doc, start) in enumerate(zip(r.doc_ids, r.doc_starts, strict=True)):
            pieces.setdefault(doc, []).append((start, tuple(r.ids[ends[j] : ends[j + 1]])))
    return pieces


def test_packed_sequences_give_every_text_back(spark):
    ranks = open(tokens.VOCABULARY, "rb").read()
    bpe, end = tokens.Encoder(ranks).bpe, tokens.Settings().end
    assert isinstance(bpe, tiktoken.Encoding)
    given = texts()
    docs = spark.createDataFrame(given, "doc_id long, text string, bin_id string, key int").repartition(3)
    sizes = (64, 128, 256, 384, 512, 768, 1024)
    rows = packing.packed_sequences(docs, capacities=sizes, block=20).collect()
    got = whole(rows)
    want = {}
    for i, text, *_ in given:
        ids = [*bpe.encode_ordinary(text or ""), end]
        want.setdefault(i, []).extend((at, tuple(ids[at : at + 1024])) for at in range(0, len(ids), 1024))
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}
    assert all(r.bin_capacity == min(c for c in sizes if c >= r.n_tokens) for r in rows)
    assert len({r.bin_id for r in rows}) == len(rows) and len({r.bin_capacity for r in rows}) > 1


def test_packed_sequences_of_an_empty_table(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert packing.packed_sequences(none).collect() == []
