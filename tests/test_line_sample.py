"""Lines sampled by byte ranges: exactly n, fixed by the seed, evenly, and without reading the file."""

from __future__ import annotations

import io
import random
from collections import Counter

import pytest

from cytoflux.sources import line_sample


def write(path, n, seed=1, head="#chrom\tpos\n"):
    rng = random.Random(seed)
    lines = [f"chr{i % 22}\t{i}\t{'x' * rng.randrange(1, 60)}" for i in range(n)]
    path.write_text(head + "\n".join(lines) + ("\n" if seed % 2 else ""))
    return lines


@pytest.mark.parametrize("block", [1, 7, 64, 1000])
def test_every_line_is_in_one_block(block):
    rng = random.Random(block)
    for end in (b"", b"\n"):
        lines = [b"y" * rng.choice([0, 0, 1, 5, 70]) for _ in range(60)] + [b"z"]
        data = b"\n".join(lines) + end
        got = [x for s in range(0, len(data), block) for x in line_sample.lines_of_block(io.BytesIO(data), s, min(s + block, len(data)))]
        places = [sum(len(x) + 1 for x in lines[:i]) for i in range(len(lines))]
        assert got == list(zip(places, lines, strict=True))


def test_exact_numbers(spark, tmp_path):
    lines = {f"{tmp_path}/{k}.tsv": write(tmp_path / f"{k}.tsv", n, n) for k, n in (("a", 5001), ("b", 2000), ("c", 30), ("d", 0))}
    sample = line_sample.sample_lines(spark, list(lines), 100, seed=3, block=256)
    got: dict = {}
    for r in sample.collect():
        got.setdefault(r.path, []).append(r.line)
    assert {p: len(x) for p, x in got.items()} == {p: min(100, len(x)) for p, x in lines.items() if x}
    assert all(set(x) <= set(lines[p]) and len(set(x)) == len(x) for p, x in got.items())
    assert sorted(map(tuple, line_sample.sample_lines(spark, list(lines), 100, seed=3, block=256).collect())) == sorted(map(tuple, sample.collect()))
    assert sorted(map(tuple, line_sample.sample_lines(spark, list(lines), 100, seed=4, block=256).collect())) != sorted(map(tuple, sample.collect()))
    with pytest.raises(ValueError):
        line_sample.sample_lines(spark, ["x.tsv.gz"], 5)


def test_bytes_read(tmp_path):
    """Head and blocks: about one and a half times the lines asked for."""
    write(tmp_path / "big.tsv", 200_000)
    size = (tmp_path / "big.tsv").stat().st_size
    ranges, whole = line_sample.plan_blocks(str(tmp_path / "big.tsv"), 1000, 1, 0)

    class Counted(io.BytesIO):
        taken = 0

        def read(self, n=-1):
            out = super().read(n)
            Counted.taken += len(out)
            return out

    file = Counted((tmp_path / "big.tsv").read_bytes())
    n = sum(1 for a, b in ranges for _ in line_sample.lines_of_block(file, a, b))
    assert not whole and 1000 <= n <= 2000 and Counted.taken + line_sample.HEAD < 0.03 * size
    # Fewer lines than the head promised: more blocks, and the first ones among them.
    more, _ = line_sample.plan_blocks(str(tmp_path / "big.tsv"), 1000, 1, 2)
    assert len(more) == 4 * len(ranges)


def test_lines_are_met_evenly(tmp_path):
    """Long and short lines alike: by blocks, and not by the byte that a draw hits."""
    (tmp_path / "f.tsv").write_text("".join(("s\n" if i % 2 else f"{'long' * 30}\n") for i in range(20_000)))
    met: Counter = Counter()
    for seed in range(30):
        ranges, _ = line_sample.plan_blocks(str(tmp_path / "f.tsv"), 200, seed, 0, 512)
        file, _ = line_sample.open_file(str(tmp_path / "f.tsv"))
        met.update(len(x) > 1 for a, b in ranges for _, x in line_sample.lines_of_block(file, a, b))
    assert abs(met[True] / met.total() - 0.5) < 0.01
