"""Responders that give any number of rows."""

from __future__ import annotations

import pytest

from modelyard.operators import rowwise


def _steps():
    # Made here, so that it travels to the tasks by value.
    class Steps:
        """Differences to the row before, repeated as often as asked; a total at the end."""

        def __init__(self, times=1):
            self.times, self.last, self.total, self.group = times, None, 0, None

        def row(self, row):
            self.group = row["g"]
            if self.last is not None:
                for _ in range(self.times):
                    yield row["g"], row["o"], row["v"] - self.last
            self.last = row["v"]
            self.total += row["v"]

        def end(self):
            yield self.group, -1, self.total

    return Steps


@pytest.fixture(scope="module")
def table(spark):
    rows = [(f"g{i % 7}" if i % 3 else "hot", i, i * i % 31) for i in range(500)] + [(None, 1, 5)]
    return spark.createDataFrame(rows, "g string, o bigint, v bigint").repartition(8), rows


@pytest.mark.parametrize("times", [0, 1, 3])
def test_groups_are_read_in_order(table, times):
    df, rows = table
    got = sorted(tuple(r) for r in rowwise.respond_rows(df, _steps(), "g string, o bigint, d bigint", ["g"], ["o"], times=times).collect())
    wanted = []
    for g in {r[0] for r in rows if r[0] is not None}:
        own = sorted(r[1:] for r in rows if r[0] == g)
        wanted += [(g, o, v - before) for (_, before), (o, v) in zip(own, own[1:]) for _ in range(times)]
        wanted.append((g, -1, sum(v for _, v in own)))
    assert got == sorted(wanted)


def test_empty_tables_and_missing_groups(table):
    df, _ = table
    schema = "g string, o bigint, d bigint"
    assert rowwise.respond_rows(df.limit(0), _steps(), schema, ["g"], ["o"]).count() == 0
    assert rowwise.respond_rows(df.where("g IS NULL"), _steps(), schema, ["g"], ["o"]).count() == 0
    with pytest.raises(ValueError, match="group"):
        rowwise.respond_rows(df, _steps(), schema, [], ["o"])
