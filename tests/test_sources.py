import pytest

import gaugeframe as gf
from gaugeframe.sources.scratch import materialize, scratch_root


def test_csv_types_and_nan(spark, tmp_path):
    (tmp_path / "t.csv").write_text("id,Driver's age(y),kind\n1,2.5,a\n2,NaN,\n3,,b\n")
    df = gf.load_table(spark, str(tmp_path / "t.csv"))
    assert dict(df.dtypes) == {"id": "int", "Driver's age(y)": "double", "kind": "string"}
    assert [r[1] for r in df.collect()] == [2.5, None, None]
    typed = gf.load_table(spark, str(tmp_path / "t.csv"), schema="a long, b double, c string")
    assert typed.columns == ["a", "b", "c"]


def test_parquet_nan_and_decimals(spark, tmp_path):
    spark.sql("select double('NaN') as x, cast(1.25 as decimal(6,2)) as d").write.parquet(
        str(tmp_path / "t.parquet"))
    assert gf.load_table(spark, str(tmp_path / "t.parquet")).first() == (None, 1.25)


def test_other_formats_are_refused(spark):
    with pytest.raises(ValueError, match="CSV or parquet"):
        gf.load_table(spark, "table.txt")


class Session:
    """What scratch_root reads of a session."""

    def __init__(self, master, setting=None):
        self.conf = {"spark.checkpoint.dir": setting} if setting else {}
        self.sparkContext, self.master, self.dir = self, master, None

    def getCheckpointDir(self):
        return self.dir

    def setCheckpointDir(self, path):
        self.dir = path


def test_scratch_follows_the_session():
    assert scratch_root(Session("spark://host:7077", "/shared/work/")) == "/shared/work"
    local = Session("local[2]")
    assert scratch_root(local) == scratch_root(local) and "gaugeframe-" in local.dir
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_root(Session("spark://host:7077"))


def test_materialized_tables_keep_odd_names(spark):
    df = materialize(spark.range(6).selectExpr("id as `odd (name)`", "id % 2 as part"), "x",
                     ["part"])
    assert df.columns == ["odd (name)", "part"] and df.where("part = 1").count() == 3
