"""The pipeline, stage by stage, against what each stage promises."""
import corpus_pipeline
from test_dedup import brute_components, brute_repeats, lowered


def test_stages(spark, docs, monkeypatch):
    from tidewater.session import materialise

    before = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = materialise(stage(spark, before, ""), name)
        assert after.columns == docs.columns
        old, new = before.collect(), after.collect()
        if name == "exact_dedup":
            last = {}
            for r in old:
                last[lowered(r["text"])] = max(last.get(lowered(r["text"]), -1), -1 if r["doc_id"] is None else r["doc_id"])
            assert sorted(last.values()) == sorted(-1 if r["doc_id"] is None else r["doc_id"] for r in new)
        if name == "near_dedup":
            want = brute_components([(r["doc_id"], r["text"]) for r in old if r["doc_id"] is not None], 5, 75)
            assert {r["doc_id"] for r in new} - {None} == {i for i, (_, c) in want.items() if i == c}
        if name == "substring_dedup":
            want = {i: (removed, kept) for i, _, removed, kept in brute_repeats([(r["doc_id"], r["text"]) for r in old], 35)}
            texts = {r["doc_id"]: r["text"] for r in old}
            assert {r["doc_id"]: r["text"] for r in new} == {i: kept if removed else texts[i] for i, (removed, kept) in want.items()}
        before = after
    packed = corpus_pipeline.STAGES[-1][1](spark, before, "")
    assert packed.select("doc_id").distinct().count() == before.count()


def test_run(spark, sf_dir):
    rows = corpus_pipeline.run(spark, sf_dir)
    assert rows.columns[:5] == ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert rows.count() > 0
