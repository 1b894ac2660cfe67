import pyarrow as pa

from marlstone.llm import arrays, decontaminate, near_dedup


def test_a_task_gives_back_its_memory_whether_read_to_the_end_or_not(monkeypatch):
    given = []
    monkeypatch.setattr(arrays, "give_back", lambda: given.append(1))
    batch = pa.record_batch({"x": [1, 2]})
    run = arrays.giving_back(lambda batches: iter(batches))
    assert list(run(iter([batch, batch]))) == [batch, batch] and given == [1]
    half = run(iter([batch, batch]))
    assert next(half) == batch
    half.close()
    assert given == [1, 1]


def test_texts_are_hashed_in_slices_of_a_megabyte():
    batch = pa.record_batch({"text": ["word " * 20_000] * 40})
    for module in (near_dedup, decontaminate):
        parts = list(arrays.byte_slices(batch, "text", module.SLICE_BYTES))
        assert sum(p.num_rows for p in parts) == 40
        assert max(sum(map(len, p.column("text").to_pylist())) for p in parts) <= 1 << 20
