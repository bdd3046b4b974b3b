"""Samples of lines of large text files that read about as many lines as they return.

A file is a row of blocks of a few kB. Some blocks, in an order that the seed fixes, are read by their byte ranges; a line
belongs to the block that it begins in, so that every line is as likely to be met as any other. Too few lines are followed
by twice as many blocks, until there are enough or the file ends.
"""

from __future__ import annotations

import json
import random
from collections.abc import Iterator
from typing import BinaryIO

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

BLOCK = 4096
#: Bytes at the head of a file from which the length of its lines is estimated, and blocks of one task.
HEAD, BLOCKS_A_TASK = 1 << 16, 256
SCHEMA = "path string, place long, line string"


def open_file(path: str) -> tuple[BinaryIO, int]:
    """The file and its size, on any file system that Arrow knows."""
    system, inner = fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)
    return system.open_input_file(inner), system.get_file_info(inner).size


def lines_of_block(file: BinaryIO, start: int, end: int) -> Iterator[tuple[int, bytes]]:
    """Place and bytes of the lines that begin in [start, end), the last one whole, wherever it ends."""
    at = max(start - 1, 0)
    file.seek(at)
    data, whole = file.read(end - at), False
    if start:  # the line that goes on into the block belongs to an earlier one
        skip = data.find(b"\n") + 1
        if not skip:
            return
        at, data = at + skip, data[skip:]
    while not whole and not data.endswith(b"\n"):
        more = file.read(256)
        cut = more.find(b"\n") + 1
        whole = bool(cut) or not more
        data += more[: cut or None]
    for line in data.split(b"\n")[:-1] if data.endswith(b"\n") else data.split(b"\n"):
        if at >= end:
            return
        yield at, line.rstrip(b"\r")
        at += len(line) + 1


class _Blocks(InputPartition):
    def __init__(self, path: str, ranges: list[tuple[int, int]]):
        self.path, self.ranges = path, ranges


class _Reader(DataSourceReader):
    def __init__(self, plan: dict[str, list[tuple[int, int]]]):
        self.plan = plan

    def partitions(self) -> list[InputPartition]:
        return [_Blocks(p, r[i : i + BLOCKS_A_TASK]) for p, r in self.plan.items() for i in range(0, len(r), BLOCKS_A_TASK)] or [_Blocks("", [])]

    def read(self, partition: InputPartition) -> Iterator[tuple[str, int, str]]:
        if not partition.ranges:
            return
        file, _ = open_file(partition.path)
        with file:
            for start, end in partition.ranges:
                for place, line in lines_of_block(file, start, end):
                    if line and not line.startswith(b"#"):
                        yield partition.path, place, line.decode("utf-8", "replace")


class LineBlocks(DataSource):
    """Lines of given byte ranges: option plan, a JSON object of lists of [start, end] by path."""

    @classmethod
    def name(cls) -> str:
        return "line_blocks"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: object) -> DataSourceReader:
        return _Reader(json.loads(self.options["plan"]))


def plan_blocks(path: str, n: int, seed: int, rounds: int, block: int = BLOCK) -> tuple[list[tuple[int, int]], bool]:
    """The byte ranges for about 1.5 n lines, twice as many for every round more; and whether they are the whole file."""
    file, size = open_file(path)
    with file:
        head = file.read(min(HEAD, size))
    mean = len(head) / max(head.count(b"\n"), 1)
    blocks = -(-size // block)
    wanted = min(blocks, max(1, int(1.5 * n * mean / block) + 1) << rounds)
    chosen = random.Random(f"{seed}:{path}").sample(range(blocks), wanted) if wanted < blocks else range(blocks)
    return [(b * block, min((b + 1) * block, size)) for b in sorted(chosen)], wanted >= blocks


def sample_lines(spark: SparkSession, paths: list[str], n: int, seed: int = 1992, block: int = BLOCK) -> DataFrame:
    """path, place and line: n lines of each file, or all of them, that the seed, the path and the file fix.

    Comment lines (#) and empty ones don't count. Plain text only: a compressed file has no byte ranges and is an error. Blocks are drawn, so
    that neighbouring lines come together more often than single draws would bring them; each line is as likely as any other.
    """
    if packed := [p for p in paths if p.endswith((".gz", ".bz2", ".zst"))]:
        raise ValueError(f"no byte ranges in {packed}")
    spark.dataSource.register(LineBlocks)
    wanted, rounds, plan = list(dict.fromkeys(paths)), 0, {}
    short = wanted
    while short:
        planned = {p: plan_blocks(p, n, seed, rounds, block) for p in short}
        plan |= {p: ranges for p, (ranges, _) in planned.items()}
        read = _read(spark, {p: plan[p] for p in short})
        counts = {r["path"]: r["n"] for r in read.groupBy("path").agg(F.count("*").alias("n")).collect()}
        short = [p for p in short if counts.get(p, 0) < n and not planned[p][1]]
        rounds += 1
    order = Window.partitionBy("path").orderBy(F.xxhash64(F.lit(seed), "path", "place"), "place")
    return _read(spark, plan).withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= n).drop("nth")


def _read(spark: SparkSession, plan: dict[str, list[tuple[int, int]]]) -> DataFrame:
    return spark.read.format("line_blocks").option("plan", json.dumps(plan)).load()
