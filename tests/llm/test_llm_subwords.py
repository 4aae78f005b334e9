"""Subword ids do not depend on how much text is encoded at a time."""

import numpy as np
import pyarrow as pa

from traitlab.llm import subwords, token_table


def test_ids_are_the_same_at_every_slice_size():
    texts = pa.array([f"word{i} and word{i * 7 % 50}\nline  two" if i % 3 else f"plain text {i}" for i in range(400)])
    coder = subwords.encoder()
    got = []
    for size in (1, 1000, token_table.CHUNK_BYTES):
        parts = list(coder.chunks(texts, chunk_bytes=size))
        got.append((len(parts), np.concatenate([ids for _, ids, _ in parts]).tolist()))
    assert [n for n, _ in got][::2] == [400, 1] and 1 < got[1][0] < 400
    assert got[0][1] == got[1][1] == got[2][1]
    # the token table indexes the units met before half as often as other readers
    assert token_table.CHUNK_BYTES == 2 * subwords.CHUNK_BYTES
