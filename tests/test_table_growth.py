"""A run that breaks at any step of a change leaves the old table or the new one."""

from __future__ import annotations

import pytest

import locusframe as lf
from locusframe.sources import tables


class Broken(Exception):
    pass


class Steps:
    """Let the catalog changes and writes of a change happen up to a certain one, before or after which it breaks."""

    def __init__(self, monkeypatch):
        self.left, self.after, self.seen = None, False, 0
        for name in ("_run", "_save"):
            monkeypatch.setattr(tables, name, self.wrapped(getattr(tables, name)))

    def wrapped(self, function):
        def step(*args):
            self.seen += 1
            if self.left is not None:
                if self.left == 0 and not self.after:
                    raise Broken
                done = function(*args)
                if self.left == 0:
                    raise Broken
                self.left -= 1
                return done
            return function(*args)

        return step


def rows(spark, name):
    return sorted((tuple(r) for r in spark.table(name).select("k", "x", "source_file").collect()), key=repr)


def files_of(spark, name):
    return {f for t in spark.sql(f"SHOW TABLES IN {name.rpartition('.')[0]}").collect() if "__" in t.tableName
            for f in spark.table(f"{name.rpartition('.')[0]}.{t.tableName}").inputFiles()}


OLD = [(1, 5, "a"), (2, 6, "b")]


def begin(spark, name, widened):
    """A table of one segment, or of two after a change of types."""
    lf.replace_files(spark.createDataFrame(OLD, "k int, x int, source_file string"), name)
    if widened:
        lf.replace_files(spark.createDataFrame([(3, 0.5, "c")], "k int, x double, source_file string"), name)
        return [(1, 5.0, "a"), (2, 6.0, "b"), (3, 0.5, "c")]
    return OLD


CHANGES = {
    "append, wider": (False, lambda s, n: lf.append_table(s.createDataFrame([(9, "t", "z")], "k int, x string, source_file string"), n),
                      [(1, "5", "a"), (2, "6", "b"), (9, "t", "z")]),
    "replace, wider": (False, lambda s, n: lf.replace_files(s.createDataFrame([(9, 0.5, "a")], "k int, x double, source_file string"), n),
                       [(2, 6.0, "b"), (9, 0.5, "a")]),
    "replace across segments": (True, lambda s, n: lf.replace_files(s.createDataFrame(
        [(8, 1.5, "a"), (9, 2.5, "c")], "k int, x double, source_file string"), n), [(2, 6.0, "b"), (8, 1.5, "a"), (9, 2.5, "c")]),
    "replace the last of a segment": (True, lambda s, n: lf.replace_files(s.createDataFrame(
        [(8, 1.5, "a"), (9, 2.5, "b")], "k int, x double, source_file string"), n), [(3, 0.5, "c"), (8, 1.5, "a"), (9, 2.5, "b")]),
    "overwrite": (True, lambda s, n: lf.write_table(s.createDataFrame([(9, 1, "a")], "k int, x int, source_file string"), n,
                                                    partition_by="source_file"), [(9, 1, "a")]),
}


@pytest.mark.parametrize("change, after", [*((change, False) for change in CHANGES), ("replace across segments", True)])
def test_broken_change_leaves_old_or_new(spark, database, monkeypatch, change, after):
    widened, run, new = CHANGES[change]
    steps, broke = Steps(monkeypatch), 0
    for k in range(20):
        name = f"{database}.t{k}"
        old = begin(spark, name, widened)
        steps.left, steps.after = k, after
        try:
            run(spark, name)
            done = True
        except Broken:
            done, broke = False, broke + 1
        steps.left = None
        held = rows(spark, name)
        assert held in (old, new), k
        assert held == new or not done
        run(spark, name) if held == old else lf.append_table(spark.createDataFrame([], "k int, source_file string"), name)
        assert rows(spark, name) == new
        segments = {t.tableName for t in spark.sql(f"SHOW TABLES IN {database} LIKE 't{k}__*'").collect()}
        assert segments == {f"t{k}__{s}" for s in tables._state(spark, name).segments}
        if done:
            break
    assert done and broke >= 2


def test_old_files_are_not_written_again(spark, database):
    name = f"{database}.grown"
    begin(spark, name, False)
    before = files_of(spark, name)
    lf.append_table(spark.createDataFrame([(3, "t", "c")], "k int, x string, source_file string"), name)
    lf.append_table(spark.createDataFrame([(4, [1.5], "c")], "k int, x array<double>, source_file string"), name)
    assert before < files_of(spark, name)
    assert rows(spark, name) == [(1, ["5"], "a"), (2, ["6"], "b"), (3, ["t"], "c"), (4, ["1.5"], "c")]


def test_values_take_the_types_between(spark, database):
    name = f"{database}.between"
    for k, value in enumerate(("7", "0.5D", "'t'", "3")):
        lf.append_table(spark.sql(f"SELECT {k} AS k, {value} AS x, 'a' AS source_file"), name)
    assert [r.x for r in spark.table(name).orderBy("k").collect()] == ["7.0", "0.5", "t", "3"]


def test_types_widen_in_the_view_as_in_the_frame(spark, database):
    name = f"{database}.kinds"
    first = "SELECT 1 AS k, true AS a, 7 AS b, array(1, NULL) AS c, named_struct('p', 1) AS d, map('m', 1) AS e, CAST(NULL AS int) AS f, 2 AS g"
    second = "SELECT 2 AS k, 5 AS a, 1.5D AS b, array('x') AS c, 't' AS d, 't' AS e, array(3) AS f, 3 AS g"
    lf.write_table(spark.sql(first), name)
    lf.append_table(spark.sql(second), name)
    lf.append_table(spark.sql(first.replace("SELECT 1", "SELECT 3")), name)
    one, two, three = spark.table(name).orderBy("k").collect()
    assert tuple(one)[1:] == (1, 7.0, ["1", None], '{"p":1}', '{"m":1}', None, 2) == tuple(three)[1:]
    assert tuple(two)[1:] == (5, 1.5, ["x"], "t", "t", [3], 3)


def test_names_with_quotes_and_many_replaced_files(spark, database):
    name = f"{database}.odd"
    files = [f"/in/it's \\{k}/{'x' * 80}.vcf" for k in range(60)]
    lf.replace_files(spark.createDataFrame([(k, 1, f) for k, f in enumerate(files)], "k int, x int, source_file string"), name)
    lf.replace_files(spark.createDataFrame([(100 + k, 0.5, f) for k, f in enumerate(files[1:])], "k int, x double, source_file string"), name)
    assert sorted(r.k for r in spark.table(name).collect()) == [0, *range(100, 159)]
    lf.drop_files(spark, name, files[:2]) if hasattr(lf, "drop_files") else tables.drop_files(spark, name, files[:2])
    assert spark.table(name).count() == 58


@pytest.mark.parametrize("k", range(5))
def test_plain_tables_are_taken_over(spark, database, monkeypatch, k):
    """Tables of older versions grow in place, and become segments when they widen, also if that breaks."""
    name = f"{database}.plain"
    spark.createDataFrame(OLD, "k int, x int, source_file string").write.partitionBy("source_file").saveAsTable(name)
    lf.append_table(spark.createDataFrame([(3, 7, "n", "c")], "k int, x int, more string, source_file string"), name)
    assert tables._state(spark, name) is None and rows(spark, name) == [*OLD, (3, 7, "c")]
    steps = Steps(monkeypatch)
    steps.left = k
    wider = spark.createDataFrame([(4, 0.5, "a")], "k int, x double, source_file string")
    try:
        lf.replace_files(wider, name)
    except Broken:
        pass
    steps.left = None
    assert tables.table_exists(spark, name)
    lf.replace_files(wider, name)
    assert rows(spark, name) == [(2, 6.0, "b"), (3, 7.0, "c"), (4, 0.5, "a")]
    assert tables.partition_column(spark, name) == "source_file"


def test_modes_and_reset(spark, database):
    name = f"{database}.m"
    one = spark.createDataFrame([(1, 1, "a")], "k int, x int, source_file string")
    lf.write_table(one, name, mode="error")
    with pytest.raises(ValueError, match="exists"):
        lf.write_table(one, name, mode="error")
    lf.write_table(one, name, mode="append")
    assert spark.table(name).count() == 2
    with pytest.raises(ValueError, match="mode must be"):
        lf.write_table(one, name, mode="ignore")
    assert lf.reset_outputs(spark, [name]) == [name]
    assert spark.sql(f"SHOW TABLES IN {database}").count() == 0
