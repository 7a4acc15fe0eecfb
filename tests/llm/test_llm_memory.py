import tracemalloc

from geoloom.llm import common
from geoloom.llm.minhash_dedup import sketch_rows


def test_sketching_needs_little_more_than_its_texts(monkeypatch):
    texts = [" ".join(f"w{i * 31 + j}" for j in range(1000)) for i in range(512)]
    monkeypatch.setattr(common, "_powers", (common._powers[0][:1], common._powers[1][:1]))
    tracemalloc.start()
    try:
        assert sum(1 for _ in sketch_rows(texts, 5, 10, 3)) == 512
        assert tracemalloc.get_traced_memory()[1] < 48 << 20
    finally:
        tracemalloc.stop()
