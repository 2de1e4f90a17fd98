"""The pipeline from end to end on small awkward tables."""

import pytest

import corpus_pipeline
from tests.llm.conftest import PROSE


def run(spark, folder, docs, labels):
    docs.write.parquet(str(folder / "documents.parquet"))
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(folder / "labels.parquet"))
    return corpus_pipeline.run(spark, str(folder)).collect()


@pytest.mark.parametrize("rows", [[], [(None, None, None)] * 3, [(1, None, None), (2, "", "a"), (None, " \n", None)]])
def test_tables_with_nothing_in_them(spark, tmp_path, make, rows):
    found = run(spark, tmp_path, make(rows), [(1, 0, 0)])
    assert bool(found) <= bool(rows) and all(r.doc_tokens >= 1 for r in found)


def test_copies_and_toxic_documents_go_and_the_rest_is_packed(spark, tmp_path, make):
    words = PROSE.split()
    plain = [(i, " ".join(words[i % 7 :] + [f"tail{i}x{k}" for k in range(60)]), "s" if i % 3 else None) for i in range(60)]
    copies = [(100 + i, plain[i][1], "s") for i in range(20)] + [plain[30], plain[30]]
    near = [(200 + i, plain[40 + i][1] + " more", "t") for i in range(5)]
    found = run(spark, tmp_path, make(plain + copies + near + [(300, PROSE * 300, "u")]), [(i, 1, 0) for i in range(60)])
    kept = {r.doc_id for r in found}
    # Of copies the largest id stays, of near copies the least.
    assert kept & set(range(60)) <= set(range(20, 60)) and not kept & set(range(200, 205))
    pieces = sorted((r.sequence_id, r.offset, r.length) for r in found)
    ends = {}
    for sequence, offset, length in pieces:
        assert offset == ends.get(sequence, 0)
        ends[sequence] = offset + length
    assert max(ends.values()) <= 2048
