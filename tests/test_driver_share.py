"""What compaction sends to the driver follows the bytes rewritten, not the number of files."""

import re

import pytest
from pyspark.sql import functions as F

from tidevault import TELEMETRY, ChunkedTable, compress_chunks
from tidevault.operators import compact
from tidevault.operators.compact import fingerprint
from tidevault.sources.generate import telemetry


def prints(table):
    return sorted(fingerprint(table, table.read_chunks()).collect())


@pytest.mark.parametrize("verify", ["hashes", "off"])
def test_small_files_are_made_many_to_a_task(spark, root, verify):
    table = ChunkedTable(spark, root, TELEMETRY, "ts", "1 day", ["auto_id"]).create()
    table.append(telemetry(spark, "2026-05-01", 2 * 2000, "40 seconds", cars=6), "initial")
    before = prints(table)
    size = table.chunks().agg(F.sum("bytes")).first()[0]
    compress_chunks(table, table.chunk_ids(), verify, target_file_bytes=size // 200)
    assert prints(table) == before
    found = table.files_read(table.read_chunks())
    tasks = {re.match(r"part-(\d+)-", name)[1] for _, _, name, _ in found}
    assert len(found) >= 200 and len(tasks) <= 2 * spark.sparkContext.defaultParallelism
    # The files are even, in order, and their ranges of one chunk lie one after the other.
    counts = [r["rows"] for r in table.files().collect()]
    assert max(counts) <= -(-sum(counts) // 200)
    stored = table.read_chunks().select("chunk_id", "_metadata.file_name", "_metadata.row_index", "auto_id", "ts")
    files = {}
    for r in sorted(stored.collect()):
        files.setdefault((r["chunk_id"], r["file_name"]), []).append((r["auto_id"], -r["ts"].timestamp()))
    assert all(rows == sorted(rows) for rows in files.values())
    ranges = sorted((chunk, rows[0], rows[-1]) for (chunk, _), rows in files.items())
    assert all(a[2] <= b[1] for a, b in zip(ranges, ranges[1:], strict=False) if a[0] == b[0])


def test_tasks_follow_the_bytes(spark, root):
    table = ChunkedTable(spark, root, TELEMETRY, "ts", "1 day", ["auto_id"]).create()
    cores, full = spark.sparkContext.defaultParallelism, compact.TARGET_FILE_BYTES
    assert compact._range_tasks(table, 3 * 4096, 4096) == 3
    assert compact._range_tasks(table, 1 << 30, 4096) == 2 * cores
    assert compact._range_tasks(table, 1000 * full, 4096) == 1000
    assert compact._range_tasks(table, 1000 * full, 4 * full) == 250
