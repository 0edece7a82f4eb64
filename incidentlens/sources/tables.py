"""The student-information-system tables the reports read, bundled with explicit schemas.

Loaders: a folder of Parquet files (one per table), catalog tables (e.g. a ``ps`` database),
any JDBC source, or DataFrames derived from the test data. Column names are compared
case-insensitively, as in the source database, and every table is cast to its declared
schema so the reports never depend on inferred types.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, fields

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

L, I, S, D, TS = T.LongType(), T.IntegerType(), T.StringType(), T.DateType(), T.TimestampNTZType()


def _schema(*cols: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in cols])


SCHEMAS: dict[str, T.StructType] = {
    "terms": _schema(("dcid", I), ("abbreviation", S), ("FirstDay", D), ("LastDay", D), ("schoolid", I), ("portion", I)),
    "incident": _schema(("incident_id", L), ("incident_title", S), ("incident_ts", TS), ("school_number", I),
                        ("created_by", L), ("last_modified_by", L)),
    "incident_detail": _schema(("incident_detail_id", L), ("incident_id", L), ("lu_code_id", I), ("lu_sub_code_id", I)),
    "incident_lu_code": _schema(("lu_code_id", I), ("code_type", S), ("incident_category", S)),
    "incident_lu_sub_code": _schema(("lu_code_id", I), ("lu_sub_code_id", I), ("short_desc", S), ("long_desc", S)),
    "incident_action": _schema(("incident_id", L), ("action_incident_detail_id", L), ("action_resolved_desc", S),
                               ("action_plan_begin_dt", D), ("action_plan_end_dt", D), ("duration_assigned", I),
                               ("duration_actual", I)),
    "incident_person_role": _schema(("incident_id", L), ("studentid", L), ("role_incident_detail_id", L)),
    "students": _schema(("id", L), ("dcid", L), ("student_number", L), ("state_studentnumber", S), ("lastfirst", S),
                        ("schoolid", I), ("dob", D), ("street", S), ("city", S), ("state", S), ("zip", S)),
    "u_def_ext_students": _schema(("studentsdcid", L), ("sped", S), ("el", S)),
    "schools": _schema(("school_number", I), ("abbreviation", S)),
    "teachers": _schema(("id", L), ("lastfirst", S)),
    "current_selection": _schema(("dcid", L)),
    "studentcontactassoc": _schema(("studentcontactassocid", L), ("studentdcid", L), ("personid", L)),
    "studentcontactdetail": _schema(("studentcontactassocid", L), ("relationshiptypecodesetid", I)),
    "person": _schema(("id", L), ("lastname", S), ("firstname", S)),
    "codeset": _schema(("codesetid", I), ("description", S)),
    "s_ma_stu_sped_x": _schema(("studentsdcid", L), ("levelofneed", S), ("primarydisability", S)),
}

REQUIRED_TABLES = ("terms", "incident", "incident_detail", "incident_lu_code", "incident_lu_sub_code", "incident_action",
                   "incident_person_role", "students", "u_def_ext_students", "schools", "teachers")

# Tables kept in the vendor's ``ps`` schema in the source database.
PS_SCHEMA_TABLES = ("incident_action", "s_ma_stu_sped_x")


# Numeric keys that partitioned database reads are cut on; the other tables are small code tables.
PARTITION_KEYS = {
    "incident": "incident_id", "incident_detail": "incident_detail_id", "incident_action": "incident_id",
    "incident_person_role": "incident_id", "students": "id", "u_def_ext_students": "studentsdcid",
    "studentcontactassoc": "studentcontactassocid", "studentcontactdetail": "studentcontactassocid", "person": "id",
    "s_ma_stu_sped_x": "studentsdcid",
}

# Where PARTITION_KEYS is not unique, rows of one key are cut on a second column.
SECOND_KEYS = {"incident_action": "action_incident_detail_id", "incident_person_role": "role_incident_detail_id"}

# A table of the database session only: a selection is given to the report, not loaded.
SESSION_TABLES = ("current_selection",)


def jdbc_table(name: str, ps_schema: str | None = "PS") -> str:
    """A table's name in the database, qualified where it lives in the vendor's schema."""
    return f"{ps_schema}.{name.upper()}" if ps_schema and name in PS_SCHEMA_TABLES else name.upper()


def jdbc_options(name: str, ps_schema: str | None = "PS", partitions: int = 1,
                 bounds: tuple[int, int] | None = None) -> dict[str, str]:
    """Reader options of one table: with ``bounds`` (smallest and largest key) its rows come over
    ``partitions`` connections, each with its own key range."""
    options = {"dbtable": jdbc_table(name, ps_schema)}
    if bounds is not None and partitions > 1 and name in PARTITION_KEYS:
        options |= {"partitionColumn": PARTITION_KEYS[name], "lowerBound": str(bounds[0]), "upperBound": str(bounds[1]),
                    "numPartitions": str(partitions)}
    return options


def split_query(name: str, ps_schema: str | None = "PS", partitions: int = 8) -> str:
    """Query for the first key (k, s) of each of ``partitions`` slices of equally many rows (NULL keys apart)."""
    key, second = PARTITION_KEYS[name], SECOND_KEYS.get(name)
    s = f"COALESCE({second}, -1)" if second else "0"
    rows = (f"SELECT {key} AS k, {s} AS s, NTILE({partitions}) OVER (ORDER BY {key}, {s}) AS b"
            f" FROM {jdbc_table(name, ps_schema)} WHERE {key} IS NOT NULL")
    return f"SELECT k, s FROM (SELECT k, s, ROW_NUMBER() OVER (PARTITION BY b ORDER BY k, s) AS r FROM ({rows}) x) y WHERE r = 1"


def split_predicates(name: str, firsts: list[tuple[int, int]]) -> list[str]:
    """One condition per slice; together they hold for every row once, those with a NULL key in the first."""
    key, second = PARTITION_KEYS[name], SECOND_KEYS.get(name)

    def from_(k: int, s: int) -> str:
        return f"({key} > {k} OR ({key} = {k} AND COALESCE({second}, -1) >= {s}))" if second else f"{key} >= {k}"

    def below(k: int, s: int) -> str:
        return f"({key} < {k} OR ({key} = {k} AND COALESCE({second}, -1) < {s}))" if second else f"{key} < {k}"

    cuts = sorted({(int(k), int(s)) for k, s in firsts})[1:]
    if not cuts:
        return ["1 = 1"]
    inner = [f"{from_(*a)} AND {below(*b)}" for a, b in zip(cuts, cuts[1:])]
    return [f"{below(*cuts[0])} OR {key} IS NULL", *inner, from_(*cuts[-1])]


def _absent(error: Exception) -> bool:
    """Whether a database says that a table or view does not exist (by SQLSTATE or its own code)."""
    text = str(error)
    return any(mark in text for mark in ("ORA-00942", "42S02", "42P01", "TABLE_OR_VIEW_NOT_FOUND"))


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select the declared columns (matched case-insensitively) and cast them to the declared types."""
    by_lower = {c.lower(): c for c in df.columns}
    cols = []
    for f in schema.fields:
        src = by_lower.get(f.name.lower())
        if src is None:
            raise ValueError(f"missing column {f.name!r}; have {df.columns}")
        c = F.col(f"`{src}`")
        if df.schema[src].dataType != f.dataType:
            c = c.cast(f.dataType)
        cols.append(c.alias(f.name))
    return df.select(*cols)


@dataclass(frozen=True)
class SisTables:
    terms: DataFrame
    incident: DataFrame
    incident_detail: DataFrame
    incident_lu_code: DataFrame
    incident_lu_sub_code: DataFrame
    incident_action: DataFrame
    incident_person_role: DataFrame
    students: DataFrame
    u_def_ext_students: DataFrame
    schools: DataFrame
    teachers: DataFrame
    current_selection: DataFrame | None = None
    studentcontactassoc: DataFrame | None = None
    studentcontactdetail: DataFrame | None = None
    person: DataFrame | None = None
    codeset: DataFrame | None = None
    s_ma_stu_sped_x: DataFrame | None = None
    # parts of incident_detail that a store laid out for the reports can give (see ``layout``)
    own_detail: DataFrame | None = None
    named_detail: DataFrame | None = None

    def details_of_incidents(self) -> DataFrame:
        """``incident_detail`` to be met by incident."""
        return self.incident_detail if self.own_detail is None else self.own_detail

    def details_by_id(self) -> DataFrame:
        """``incident_detail`` to be met by the ids that roles and actions name."""
        return self.incident_detail if self.named_detail is None else self.named_detail

    @classmethod
    def from_frames(cls, frames: dict[str, DataFrame]) -> "SisTables":
        wanted = {f.name for f in fields(cls)}
        return cls(**{name: conform(df, SCHEMAS[name]) for name, df in frames.items() if name in wanted & set(SCHEMAS)})

    @classmethod
    def from_parquet_dir(cls, spark: SparkSession, path: str, names: list[str] | None = None) -> "SisTables":
        """One Parquet dataset per table under ``path`` (``path/incident``, ``path/students``, ...).

        Optional tables (selection, contacts, state SPED) may be absent; only the reports that
        need them fail, naming what is missing.
        """
        frames = {}
        for n in names or list(SCHEMAS):
            try:
                frames[n] = spark.read.schema(SCHEMAS[n]).parquet(f"{path}/{n}")
            except AnalysisException as e:
                if e.getCondition() != "PATH_NOT_FOUND" or n in REQUIRED_TABLES:
                    raise
        return cls.from_frames(frames)

    @classmethod
    def from_catalog(cls, spark: SparkSession, database: str | None = None, ps_database: str | None = "ps",
                     names: list[str] | None = None) -> "SisTables":
        """Catalog tables; ``incident_action`` and ``s_ma_stu_sped_x`` live in ``ps_database``.

        With ``database``/``ps_database`` None the plain names are used (e.g. temporary views).
        Optional tables that do not exist are left out.
        """
        frames = {}
        for n in names or list(SCHEMAS):
            db = ps_database if n in PS_SCHEMA_TABLES else database
            name = f"{db}.{n}" if db else n
            if n in REQUIRED_TABLES or spark.catalog.tableExists(name):
                frames[n] = spark.table(name)
        return cls.from_frames(frames)

    @classmethod
    def from_jdbc(cls, spark: SparkSession, url: str, properties: dict[str, str], ps_schema: str | None = "PS",
                  names: list[str] | None = None, partitions: int = 1, split: str = "depth",
                  read: Callable[[dict], DataFrame] | None = None) -> "SisTables":
        """Read straight from the school information system's database over JDBC.

        Optional tables that the database does not have are left out; the selection table is one of
        the database session and never loaded. With ``partitions`` > 1 large tables are read in slices:
        by ``split="depth"`` of equally many rows (one query finds where to cut each table; rows with a NULL key come in
        the first slice), by ``"width"`` of equally wide key ranges (one query for the smallest and largest key).
        ``read`` takes reader options, and ``predicates`` for slices, and returns a DataFrame; by default Spark's JDBC source."""
        if split not in ("depth", "width"):
            raise ValueError(f"unknown split {split!r}")
        if read is None:
            def read(options: dict) -> DataFrame:
                options = dict(options)
                slices = options.pop("predicates", None)
                if slices is not None:
                    return spark.read.jdbc(url, options["dbtable"], predicates=slices, properties=properties)
                return spark.read.format("jdbc").options(url=url, **properties, **options).load()
        frames = {}
        for n in names or [n for n in SCHEMAS if n not in SESSION_TABLES]:
            try:
                cut = partitions > 1 and n in PARTITION_KEYS
                if cut and split == "depth":
                    firsts = [(r[0], r[1]) for r in read({"query": split_query(n, ps_schema, partitions)}).collect()]
                    frames[n] = read({"dbtable": jdbc_table(n, ps_schema), "predicates": split_predicates(n, firsts)})
                    continue
                bounds = None
                if cut:
                    key = PARTITION_KEYS[n]
                    row = read({"query": f"SELECT min({key}) AS lo, max({key}) AS hi FROM {jdbc_table(n, ps_schema)}"}).first()
                    bounds = None if row[0] is None else (int(row[0]), int(row[1]) + 1)
                frames[n] = read(jdbc_options(n, ps_schema, partitions, bounds))
            except Exception as e:  # noqa: BLE001 - the driver's own error type
                if n in REQUIRED_TABLES or not _absent(e):
                    raise
        return cls.from_frames(frames)

    def write_parquet(self, path: str, mode: str = "errorifexists") -> None:
        for name in SCHEMAS:
            df = getattr(self, name)
            if df is not None:
                df.write.mode(mode).parquet(f"{path}/{name}")

    def require(self, *names: str) -> None:
        missing = [n for n in names if getattr(self, n) is None]
        if missing:
            raise ValueError(f"tables required but not given: {missing}")


def from_testdata(spark: SparkSession, sf_dir: str) -> SisTables:
    """SIS tables derived lazily from the TPC-H-style test data (see ``fixtures``)."""
    from .fixtures import derive_frames

    return SisTables.from_frames(derive_frames(spark, sf_dir))
