"""Positional block files: exact names, row positions, older files, half-written folders."""

import os

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from exactnn.sources import blocks as BF


def _lists(spark, blocks, queries, k=4):
    rows = [
        (b, q, [10 * b + q + i for i in range(k - (q % 3 == 2))], [float(i) + b / 10 for i in range(k - (q % 3 == 2))])
        for b in blocks for q in range(queries)
    ]
    return spark.createDataFrame(rows, "block_id int, query_id long, neighbors array<long>, distances array<double>").repartition(5)


def test_files_have_their_names_and_rows_their_places(spark, tmp_path):
    folder = str(tmp_path / "run")
    BF.write_blocks(_lists(spark, [0, 7], 9), folder, 4)
    assert sorted(f for f in os.listdir(folder) if not f.startswith(".")) == [
        "distances0.parquet", "distances7.parquet", "indices0.parquet", "indices7.parquet"
    ]
    table = pq.read_table(f"{folder}/indices7.parquet").to_pydict()
    assert list(table) == ["0", "1", "2", "3"]
    assert table["0"] == [70 + q for q in range(9)] and table["3"][2] is None
    found = {(r.block_id, r.query_id): (r.neighbors, r.distances) for r in BF.block_lists(spark, folder).collect()}
    assert len(found) == 18 and found[7, 5] == ([75, 76, 77], [0.7, 1.7, 2.7])
    merged = sorted(tuple(r) for r in BF.merge_blocks(spark, folder, 3).where("query_id = 1").collect())
    assert merged == [(1, 0, 1, 0.0), (1, 1, 71, 0.7), (1, 2, 2, 1.0)]


def test_older_files_and_more_blocks(spark, tmp_path):
    """RowNum and other column names in files that were not written here."""
    folder = str(tmp_path / "run")
    BF.write_blocks(_lists(spark, [1], 4), folder, 4, row_number=True)
    assert "RowNum" in pq.read_schema(f"{folder}/indices1.parquet").names
    wide = {f"embedding_{i}": [0.01 * (q + i) for q in range(4)] for i in range(4)} | {"RowNum": list(range(4))}
    pq.write_table(pa.table(wide), f"{folder}/distances3.parquet")
    pq.write_table(pa.table({f"col_{i}": [100 + q + i for q in range(4)] for i in range(4)}), f"{folder}/indices3.parquet")
    merged = [tuple(r) for r in BF.merge_blocks(spark, folder, 2).where("query_id = 0").orderBy("rank").collect()]
    assert [m[:3] for m in merged] == [(0, 0, 100), (0, 1, 101)]
    manifest = {(r.block_id, r.kind): (r.row_count, r.places) for r in BF.block_manifest(spark, folder).collect()}
    assert manifest[1, "indices"] == (4, 15) and manifest[3, "distances"] == (4, 16)


def test_refused(spark, tmp_path):
    folder = str(tmp_path / "run")
    BF.write_blocks(_lists(spark, [2], 3), folder, 4)
    with pytest.raises(Exception, match="already"):
        BF.write_blocks(_lists(spark, [2], 3), folder, 4)
    BF.write_blocks(_lists(spark, [2], 5), folder, 4, mode="overwrite")
    assert BF.block_lists(spark, folder).count() == 5
    with pytest.raises(Exception, match="positions"):
        BF.write_blocks(_lists(spark, [4], 5).where("query_id <> 2"), folder, 4)
    with pytest.raises(Exception, match="longer"):
        BF.write_blocks(_lists(spark, [4], 5), folder, 3)
    assert not [f for f in os.listdir(folder) if "4" in f or f.startswith("_temporary")]
    os.remove(f"{folder}/distances2.parquet")
    BF.write_blocks(_lists(spark, [5], 5), folder, 4)
    with pytest.raises(Exception, match="unpaired"):
        BF.block_lists(spark, folder).collect()
