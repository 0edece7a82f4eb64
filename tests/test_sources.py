"""Loaders and stored fixtures."""

from __future__ import annotations

import shutil

import pytest

from incidentlens import session
from incidentlens.sources import fixtures, tables
from incidentlens.sources.tables import SCHEMAS, SisTables

from .conftest import SF_SMALL, base_rows


def test_jdbc_names_and_options():
    assert tables.jdbc_table("incident_action") == "PS.INCIDENT_ACTION"
    assert tables.jdbc_table("incident_action", None) == "INCIDENT_ACTION"
    assert tables.jdbc_table("students") == "STUDENTS"
    assert tables.jdbc_options("schools", partitions=8, bounds=(1, 9)) == {"dbtable": "SCHOOLS"}
    assert tables.jdbc_options("incident", partitions=8, bounds=(1, 9)) == {
        "dbtable": "INCIDENT", "partitionColumn": "incident_id", "lowerBound": "1", "upperBound": "9", "numPartitions": "8"}


def test_jdbc_loader_skips_absent_optional_tables(spark):
    rows, asked = base_rows(), []
    frames = {tables.jdbc_table(n): spark.createDataFrame(r, SCHEMAS[n]) for n, r in rows.items()}

    def read(options):
        asked.append(options)
        if "query" in options:
            frames[options["query"].split(" FROM ")[1]].createOrReplaceTempView("asked_table")
            return spark.sql(options["query"].split(" FROM ")[0] + " FROM asked_table")
        if options["dbtable"] == "PERSON":
            raise RuntimeError("java.sql.SQLSyntaxErrorException: ORA-00942: table or view does not exist")
        return frames[options["dbtable"]]

    t = SisTables.from_jdbc(spark, "jdbc:x", {}, partitions=4, split="width", read=read, names=[n for n in SCHEMAS if n != "person"])
    assert t.person is None and t.incident.count() == 1
    t = SisTables.from_jdbc(spark, "jdbc:x", {}, read=read, names=["students", "incident", *[
        n for n in tables.REQUIRED_TABLES if n not in ("students", "incident")], "s_ma_stu_sped_x"])
    assert t.s_ma_stu_sped_x.count() == 1 and t.current_selection is None
    assert {"dbtable": "PS.S_MA_STU_SPED_X"} in asked
    ranged = next(o for o in asked if o.get("dbtable") == "STUDENTS" and "numPartitions" in o)
    assert (ranged["lowerBound"], ranged["upperBound"]) == ("7", "9")

    def broken(options):
        raise RuntimeError("connection refused")

    with pytest.raises(RuntimeError, match="refused"):
        SisTables.from_jdbc(spark, "jdbc:x", {}, read=broken)


def test_catalog_with_a_ps_database(spark, tmp_path):
    rows = base_rows()
    spark.sql(f"CREATE DATABASE ps LOCATION '{tmp_path}/ps'")
    spark.sql(f"CREATE DATABASE sis LOCATION '{tmp_path}/sis'")
    try:
        for n, r in rows.items():
            if n != "codeset":
                db = "ps" if n in tables.PS_SCHEMA_TABLES else "sis"
                spark.createDataFrame(r, SCHEMAS[n]).write.saveAsTable(f"{db}.{n}")
        t = SisTables.from_catalog(spark, "sis")
        assert t.incident_action.count() == 1 and t.s_ma_stu_sped_x.count() == 1 and t.codeset is None
    finally:
        spark.sql("DROP DATABASE ps CASCADE")
        spark.sql("DROP DATABASE sis CASCADE")


def test_only_missing_folders_count_as_absent(spark, tmp_path):
    t = SisTables.from_frames({n: spark.createDataFrame(r, SCHEMAS[n]) for n, r in base_rows().items()})
    t.write_parquet(str(tmp_path / "sis"))
    shutil.rmtree(tmp_path / "sis" / "codeset")
    assert SisTables.from_parquet_dir(spark, str(tmp_path / "sis")).codeset is None
    shutil.rmtree(tmp_path / "sis" / "incident")
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        SisTables.from_parquet_dir(spark, str(tmp_path / "sis"))


def test_stored_fixtures_follow_their_source(spark, tmp_path):
    sf = tmp_path / "sf"
    sf.mkdir()
    for n in ("nation", "customer", "supplier", "part", "orders", "lineitem", "region"):
        shutil.copyfile(f"{SF_SMALL}/{n}.parquet", sf / f"{n}.parquet")
    one = fixtures.materialize(spark, str(sf), str(tmp_path / "root"), ["schools"])
    assert fixtures.materialize(spark, str(sf), str(tmp_path / "root"), ["schools"]) == one
    assert sorted(p.name for p in (tmp_path / "root").joinpath(one.rsplit("/", 1)[1]).iterdir()) == ["schools"]
    small = spark.read.parquet(f"{SF_SMALL}/nation.parquet").limit(3).toPandas()
    small.to_parquet(sf / "nation.parquet")
    two = fixtures.materialize(spark, str(sf), str(tmp_path / "root"), ["schools"])
    assert two != one and spark.read.parquet(f"{two}/schools").count() <= 4


def test_checkpoint_folder_must_be_named_on_a_cluster(monkeypatch):
    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://host:7077"

        def getConf(self):
            return Conf()

        def getCheckpointDir(self):
            return None

    class Session:
        conf = Conf()
        sparkContext = Context()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.checkpoint_dir(Session())


def _stand_in(spark, frames, asked):
    """A reader of temporary views in place of a database; ``asked`` gets every predicate list."""
    views = {tables.jdbc_table(n): f"stand_in_{n}" for n in frames}
    for n, df in frames.items():
        df.createOrReplaceTempView(f"stand_in_{n}")

    def read(options):
        if "query" in options:
            text = options["query"]
            for name, view in views.items():
                text = text.replace(f" {name} ", f" {view} ")
            return spark.sql(text)
        if "predicates" not in options:
            return spark.table(views[options["dbtable"]])
        asked[options["dbtable"]] = options["predicates"]
        parts = [spark.table(views[options["dbtable"]]).where(p) for p in options["predicates"]]
        out = parts[0]
        for p in parts[1:]:
            out = out.unionAll(p)
        return out

    return read


@pytest.mark.parametrize("partitions", [2, 7])
def test_jdbc_slices_of_equal_depth(spark, partitions):
    """Keys far apart, one key with a third of all rows, NULL keys: slices within 2x, every row once."""
    rows = base_rows()
    frames = {n: spark.createDataFrame(rows[n], SCHEMAS[n]) for n in rows}
    frames["students"] = spark.createDataFrame(
        [(k if k < 900 else k ** 5, *rows["students"][0][1:]) for k in range(1000)], SCHEMAS["students"])
    roles = [(5 if k % 3 == 0 else 10 ** 9 + k, k, k if k % 7 else None) for k in range(900)] + [(None, 1, 1)] * 20
    frames["incident_person_role"] = spark.createDataFrame(roles, SCHEMAS["incident_person_role"])
    asked = {}
    t = SisTables.from_jdbc(spark, "jdbc:x", {}, partitions=partitions, read=_stand_in(spark, frames, asked),
                            names=[n for n in SCHEMAS if n in rows])
    for n in ("students", "incident_person_role", "incident"):
        assert sorted(map(str, getattr(t, n).collect())) == sorted(map(str, frames[n].collect()))
    for n, spare in (("students", 0), ("incident_person_role", 20)):
        sizes = [spark.table(f"stand_in_{n}").where(p).count() for p in asked[tables.jdbc_table(n)]]
        assert len(sizes) == partitions and max(sizes) <= 2 * min(sizes) + spare
    assert asked["INCIDENT"] == ["1 = 1"]


def test_jdbc_slices_of_an_empty_table_and_bad_split(spark):
    rows = base_rows() | {"incident_person_role": [], "incident_action": [(None, 13, None, None, None, None, None)]}
    frames = {n: spark.createDataFrame(rows[n], SCHEMAS[n]) for n in rows}
    t = SisTables.from_jdbc(spark, "jdbc:x", {}, partitions=4, read=_stand_in(spark, frames, {}), names=list(rows))
    assert t.incident_person_role.count() == 0 and t.incident_action.count() == 1
    with pytest.raises(ValueError, match="unknown split"):
        SisTables.from_jdbc(spark, "jdbc:x", {}, split="odd")
