"""Chunks of a batch of texts: worked out for a bounded number of texts at a time, each as if it stood alone."""

import pyarrow as pa

from confluo.llm.linededup import Chunker, _chunks


def test_chunks_of_texts_are_those_of_each_alone():
    said = [None, "", "One line of five words.\nAnother line of six words, here.  And more of it.", "word " * 90 + "end", "a  b\tc d  " * 30]
    texts = [said[k % 5] for k in range(700)]

    def rows(own):
        b = pa.RecordBatch.from_arrays([pa.array(range(len(own)), pa.int64()), pa.array(range(len(own)), pa.int64()), pa.array(own, pa.string())], ["id", "mark", "text"])
        return list(_chunks(Chunker())(iter([b])))

    found = rows(texts)
    assert len(found) > 1
    alone = [[tuple(r.values())[2:] for b in rows([t]) for r in b.to_pylist()] for t in said]
    for k in (*range(5), 255, 256, 257, *range(695, 700)):
        assert [tuple(r.values())[2:] for b in found for r in b.to_pylist() if r["id"] == k] == alone[k % 5]
    assert sum(b.num_rows for b in found) == 140 * sum(map(len, alone)) and alone[2] and alone[3] and alone[4]
