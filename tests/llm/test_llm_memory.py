import pyarrow as pa

from lodestat.llm.tokens import parts


def test_a_call_of_the_encoder_gets_about_four_megabytes():
    texts = pa.array(["x" * (1 << 20)] * 9 + [None])
    cuts = parts(texts)
    assert [i for i, _ in cuts] == [0] + [j for _, j in cuts[:-1]] and cuts[-1][1] == 10
    assert max(j - i for i, j in cuts) <= 5
