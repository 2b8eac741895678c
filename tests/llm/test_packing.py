import numpy as np
import pytest

from tidemill.llm import packing


def test_long_white_space_has_the_ids_of_the_json_file(spark):
    P = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    rows = [(1, "one text"), (2, " " * 1_000_000 + "a"), (3, "b\n" + "\n" * 1_000_000 + " c"), (4, "another text")]
    t = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    got = packing.pack(spark.createDataFrame(rows, "doc_id long, text string"), P.path("byte_bpe_50k.tiktoken"), with_ids=True).collect()
    for i, text in rows:
        ids = b"".join(bytes(p.ids) for p in sorted(got, key=lambda p: p.start) if p.doc_id == i)
        assert ids == np.array(t.encode(text, add_special_tokens=False).ids + [1], "<u4").tobytes()
