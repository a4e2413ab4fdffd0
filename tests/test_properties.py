"""Property tests: column helpers agree with Python's own semantics on generated inputs."""

import decimal

from hypothesis import given, settings
from hypothesis import strategies as st

from plume.functions.columns import WS_CHARS, rnd, strip_ws, word_count_space, word_count_ws

ALPHABET = st.sampled_from(list("ab é-'.,") + list(WS_CHARS))
TEXTS = st.lists(st.text(alphabet=ALPHABET, max_size=30), min_size=1, max_size=40)


@settings(max_examples=15, deadline=None)
@given(TEXTS)
def test_text_helpers_match_python(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "v string")
    got = [tuple(r) for r in df.select(strip_ws("v"), word_count_ws("v"), word_count_space("v")).collect()]
    assert got == [(t.strip(), len(t.split()), len(t.split(" "))) for t in texts]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.floats(min_value=-1e6, max_value=1e6, allow_nan=False), min_size=1, max_size=40),
       st.integers(min_value=0, max_value=6))
def test_rounding_is_half_up_on_the_shortest_decimal(spark, xs, digits):
    df = spark.createDataFrame([(x,) for x in xs], "v double")
    got = [r[0] for r in df.select(rnd("v", digits)).collect()]
    q = decimal.Decimal(1).scaleb(-digits)

    def want(x):
        d = decimal.Decimal(repr(x)).quantize(decimal.Decimal(1).scaleb(-10), rounding=decimal.ROUND_HALF_UP)
        return float(d.quantize(q, rounding=decimal.ROUND_HALF_UP))
    assert got == [want(x) for x in xs]
