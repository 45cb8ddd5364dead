import zlib

import pyarrow as pa

from test_llm_minhash import sets_of

import corpus_pipeline as P
from sensorloom.llm import decontaminate, pii
from sensorloom.llm.common import stored
from sensorloom.llm.queries import QUERIES


def test_stages():
    assert [name for name, _ in P.STAGES] == [
        "language", "near_duplicates", "decontamination", "personal_data", "packing",
    ]
    assert {int(n[2:].split("_")[0]) for n in QUERIES} == set(range(1, 11))


def test_each_stage_takes_effect(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, sizes = docs.columns, [docs.count()]
    kept = {}
    for name, stage in P.STAGES[:-1]:
        docs = stored(stage(spark, docs, sf), name)
        assert docs.columns == columns
        kept[name] = {r.doc_id: r.text for r in docs.collect()}
        sizes.append(len(kept[name]))
    assert sizes == sorted(sizes, reverse=True) and sizes[-1] > 0.6 * sizes[0]
    # Only near-duplicates and leaks go from the clean documents of the fixture.
    texts = sets_of(kept["language"])
    least = {
        a: min(
            [a, *(b for b in texts if b < a and 100 * len(texts[a] & texts[b]) >= 80 * len(texts[a] | texts[b]) > 0)]
        )
        for a in texts
    }
    assert set(kept["near_duplicates"]) == {d for d in texts if least[d] == d}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    index = decontaminate.build_index(items)
    left = pa.RecordBatch.from_arrays([pa.array(list(kept["decontamination"].values()))], ["text"])
    assert not decontaminate.search(left, 0, index)
    before, after = kept["decontamination"], kept["personal_data"]
    for doc, text in before.items():
        found = pii.detect(text)
        assert (after[doc] == text) == (not found)
    packed = P.STAGES[-1][1](spark, docs, sf).collect()
    assert {r.doc_id for r in packed} == set(after)
    assert all(zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length for r in packed)


def test_run_is_the_stages_in_order(spark, sf):
    rows = P.run(spark, sf).collect()
    assert rows and {"doc_id", "start", "length", "sequence_id", "offset"} <= set(rows[0].asDict())


def test_odd_rows(spark, sf, odd, empty):
    for name, stage in P.STAGES:
        result = stage(spark, odd, sf)
        assert result.count() > 0, name
        assert stage(spark, empty, sf).count() == 0
        if name != "packing":
            assert result.columns == odd.columns, name
    # Null texts and texts without letters are what the language stage rejects.
    for frame in (odd, odd.withColumn("lang", odd.key)):
        left = P.language_stage(spark, frame, sf).collect()
        assert {r.doc_id for r in left} >= {1, None, 8, 9} and not {2, 3, 4} & {r.doc_id for r in left}
