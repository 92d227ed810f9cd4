"""Bad lines come back mended: published once, their rejects closed, counts that add up."""

import pytest
from core_helpers import write_text
from test_backlog import Site, line

from cellroll.streaming import backlog as bl
from cellroll.streaming.repair import all_rejects, fixes_of_lines, open_rejects, reject_report


class Mending(Site):
    def __init__(self, spark, tmp):
        super().__init__(spark, tmp)
        self.rejects = f"{tmp}/rejects"
        self.kw |= dict(on_error="reject", rejects=self.rejects, fixes_dir=f"{tmp}/fixes")
        write_text(f"{tmp}/fixes/.keep", [])

    def open(self):
        return {r.line: r.line_id for r in open_rejects(self.spark, self.rejects).collect()}

    def report(self):
        return sorted(tuple(r) for r in reject_report(self.spark, self.rejects).collect())


def test_a_mended_line_is_published_once(spark, tmp_dir):
    """Its partner waits; a mended line without one waits itself; a bad correction leaves the reject open."""
    site = Mending(spark, tmp_dir)
    bad, alone, worse = line(0, "1x"), line(5, "5x"), "too,short"
    site.put("counter", bad, bad, alone, worse, line(1, 2))
    site.put("qual", line(0, 10), line(1, 20))
    first = site.run()[0]
    assert (first.counter_lines, first.counter_rejects, first.hourly_appended, first.qual_waiting) == (5, 4, 1, 1)
    ids = site.open()
    assert set(ids) == {bad, alone, worse} and {r.line: r.copies for r in all_rejects(spark, site.rejects).collect()}[bad] == 2
    site.put("fixes", f"{ids[bad]}\t{line(0, 1)}", f"{ids[alone]}\t{line(5, 5)}", f"{ids[worse]}\tstill,short", "unknown\tx", "no tab")
    second = site.run()[0]
    assert (second.counter_lines, second.hourly_appended, second.counter_waiting, second.qual_waiting) == (3, 1, 1, 0)
    assert site.hourly() == [(1, 0, 1.0, 10.0), (1, 1, 2.0, 20.0)] and set(site.open()) == {worse}
    assert site.report() == [("counter", "arity", 1, 0, 1), ("counter", "cast:m1", 2, 2, 0)]
    # a second correction of a closed reject, and the bad file once more, change nothing
    site.put("fixes", f"{ids[bad]}\t{line(0, 77)}")
    site.put("counter", line(9, "9x"))
    third = site.run()[0]
    assert third.hourly_appended == 0 and len(site.hourly()) == 2
    assert site.report() == [("counter", "arity", 1, 0, 1), ("counter", "cast:m1", 3, 2, 1)]


@pytest.mark.parametrize("step", ["join_and_publish", "keep_rejects"])
def test_crash_and_the_same_batch_again(spark, tmp_dir, monkeypatch, step):
    site = Mending(spark, tmp_dir)
    site.put("counter", line(0, "1x"))
    site.put("qual", line(0, 10))
    site.run()
    (line_id,) = site.open().values()
    site.put("fixes", f"{line_id}\t{line(0, 4)}", f"{line_id}\t{line(0, 3)}")
    with monkeypatch.context() as m:
        m.setattr(bl, step, lambda *a, **kw: 1 / 0)
        with pytest.raises(Exception, match="division"):
            site.run()
    assert len(site.open()) == 1
    site.run()
    assert site.hourly() == [(1, 0, 3.0, 10.0)] and site.open() == {}


def test_fixes_of_lines(spark):
    lines = spark.createDataFrame([("a\tb\tc",), ("a\t",), ("none",), (None,), ("\tx",)], "value string")
    assert sorted(tuple(r) for r in fixes_of_lines(lines).collect()) == [("", "x"), ("a", ""), ("a", "b\tc")]


def test_arguments(spark, tmp_dir):
    site = Mending(spark, tmp_dir)
    lines = spark.createDataFrame([], "value string, source_file string")
    kw = {k: v for k, v in site.kw.items() if k not in ("fixes_dir", "on_error", "rejects")}
    with pytest.raises(ValueError, match="on_error"):
        bl.load_arrivals(spark, lines, lines, 0, rejects=site.rejects, **kw)
    with pytest.raises(ValueError, match="fixes"):
        bl.load_arrivals(spark, lines, lines, 0, fixes=lines, **kw)
