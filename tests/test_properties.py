"""Property tests: chunks tile the text, agree with the byte
reader, and packing keeps order and the minimum size."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from brute import chunks as brute_chunks
from brute import greedy_pack
from fileflow.operators.chunks import line_chunks
from fileflow.operators.packing import task_pack

PIECE = st.sampled_from(["a", "bc", "é", "€", "𝄞", " ", "\n", "\r", "\r\n", "x" * 40])
TEXTS = st.lists(st.lists(PIECE, max_size=40).map("".join), min_size=1, max_size=6)
SLOW = settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
SLOWER = settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


@SLOW
@given(texts=TEXTS, unit=st.integers(min_value=1, max_value=60), header=st.integers(min_value=0, max_value=3))
def test_chunks_property(spark, texts, unit, header):
    rows = list(enumerate(texts))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(tuple(r) for r in line_chunks(df, unit_bytes=unit, header_lines=header).collect())
    want = sorted((d, *c) for d, t in rows for c in brute_chunks(t.encode(), unit, header))
    assert got == want
    if header == 0:
        for d, t in rows:
            parts = sorted((c[2], c[4]) for c in got if c[0] == d)
            assert "".join(p for _, p in parts) == t


@SLOWER
@given(sizes=st.lists(st.integers(min_value=0, max_value=50), min_size=1, max_size=80),
       m=st.integers(min_value=0, max_value=200), block=st.sampled_from([2, 5, 65536]))
def test_packing_property(spark, sizes, m, block):
    rows = [("g", i, s) for i, s in enumerate(sizes)]
    df = spark.createDataFrame(rows, "g string, o long, size long")
    got = [r.task_id for r in sorted(task_pack(df, ["g"], ["o"], "size", m, block=block).collect(),
                                     key=lambda r: r.o)]
    assert got == greedy_pack(sizes, m)
