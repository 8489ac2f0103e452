"""Log files as a producer leaves them: one file a log, in a folder of whatever file system."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_files(lines: DataFrame, names: DataFrame, folder: str) -> None:
    """Write the lines of each log_file, by ord, into one file of that name; a name without
    lines gives an empty file.

    Each file is written by one task, line by line, under a temporary name first, so a task
    that runs again writes it again.
    """
    marks = names.select("log_file", F.lit(None).cast("long").alias("ord"), F.lit(None).cast("string").alias("value"))
    rows = lines.select("log_file", F.col("ord").cast("long").alias("ord"), "value").unionByName(marks)

    def run(batches):
        import pyarrow as pa
        from pyarrow import fs

        system, base = fs.FileSystem.from_uri(folder)
        system.create_dir(base, recursive=True)
        out, current = None, None

        def close():
            out.close()
            system.move(f"{base}/.{current}.part", f"{base}/{current}")

        for batch in batches:
            for name, _, value in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if name != current:
                    if out:
                        close()
                    current, out = name, system.open_output_stream(f"{base}/.{name}.part")
                if value is not None:
                    out.write(f"{value}\n".encode())
        if out:
            close()
        yield pa.RecordBatch.from_arrays([pa.array([], type=pa.int64())], names=["done"])

    dealt = rows.repartition("log_file").sortWithinPartitions("log_file", F.col("ord").asc_nulls_first())
    dealt.mapInArrow(run, "done long").write.format("noop").mode("overwrite").save()
