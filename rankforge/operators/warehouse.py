"""Table contracts, dimension and fact migration, verification (M1-M5)."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankforge.functions.columns import md5_key
from rankforge.functions.joins import broadcast_if_small


@dataclass(frozen=True)
class ForeignKey:
    columns: tuple[str, ...]
    ref_table: str
    ref_columns: tuple[str, ...]


@dataclass(frozen=True)
class TableSpec:
    """M1: declared contract of a table: column types, required columns,
    primary key, foreign keys and closed value ranges. Errors in the spec
    itself raise at construction."""
    name: str
    columns: dict
    primary_key: tuple = ()
    required: tuple = ()
    foreign_keys: tuple = ()
    ranges: dict = field(default_factory=dict)

    def __post_init__(self):
        known = set(self.columns)
        for group, cols in (("primary_key", self.primary_key), ("required", self.required),
                            ("ranges", tuple(self.ranges))):
            missing = [c for c in cols if c not in known]
            if missing:
                raise ValueError(f"{self.name}: {group} names unknown columns {missing}")
        for fk in self.foreign_keys:
            if any(c not in known for c in fk.columns) or len(fk.columns) != len(fk.ref_columns):
                raise ValueError(f"{self.name}: bad foreign key {fk}")
        for c, (lo, hi) in self.ranges.items():
            if lo is not None and hi is not None and lo > hi:
                raise ValueError(f"{self.name}: empty range for {c}")

    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(c, T._parse_datatype_string(t), c not in self.required)
                             for c, t in self.columns.items()])


def schema_problems(df: DataFrame, spec: TableSpec) -> list[str]:
    """Column-level differences between a frame and its spec (driver-side,
    schema only; no job)."""
    have = {f.name: f.dataType for f in df.schema.fields}
    out = []
    for c, t in spec.columns.items():
        if c not in have:
            out.append(f"missing column {c}")
        elif have[c] != T._parse_datatype_string(t):
            out.append(f"column {c} is {have[c].simpleString()}, spec says {t}")
    return out


_NESTED = (T.ArrayType, T.MapType, T.StructType)


def _held(c: str, have: T.DataType, want: T.DataType):
    """A column in another type; NULL where that type can't hold the value."""
    if isinstance(have, _NESTED) or isinstance(want, _NESTED):
        return F.lit(None).cast(want)
    if isinstance(have, T.NumericType) and isinstance(want, T.NumericType):
        new = F.col(c).try_cast(want)
        return F.when(new.try_cast(have).eqNullSafe(F.col(c)), new)
    return F.col(c).cast("string").try_cast(want)


def schema_rows(df: DataFrame, spec: TableSpec) -> DataFrame:
    """M1: differences between a frame's columns and its spec, as ``check, table, n_violations``.

    ``missing_column``: columns of the spec that the frame lacks. ``wrong_type``:
    columns of another type. ``bad_value``: values of those columns that the
    spec's type can't hold: text that doesn't parse, a number that changes."""
    have = {f.name: f.dataType for f in df.schema.fields}
    want = {c: T._parse_datatype_string(t) for c, t in spec.columns.items()}
    lacking = [c for c in want if c not in have]
    wrong = [c for c, t in want.items() if c in have and have[c] != t]
    lost = F.lit(0).cast("bigint")
    for c in wrong:
        gone = F.col(c).isNotNull() & _held(c, have[c], want[c]).isNull()
        lost = lost + F.sum(F.when(gone, 1).otherwise(0))
    if not wrong:
        counts = df.sparkSession.range(1).select(F.lit(0).cast("bigint").alias("lost"))
    else:
        counts = df.agg(F.coalesce(lost, F.lit(0)).cast("bigint").alias("lost"))
    rows = [("missing_column", F.lit(len(lacking)).cast("bigint")), ("wrong_type", F.lit(len(wrong)).cast("bigint")), ("bad_value", F.col("lost"))]
    each = F.array(*[F.struct(F.lit(n).alias("check"), F.lit(spec.name).alias("table"), v.alias("n_violations")) for n, v in rows])
    return counts.select(F.inline(each))


def _as_declared(df: DataFrame, spec: TableSpec) -> DataFrame:
    """``df`` with the columns of the spec in its types: missing ones NULL, values that don't fit NULL."""
    have = {f.name: f.dataType for f in df.schema.fields}
    for c, t in spec.columns.items():
        if c not in have:
            df = df.withColumn(c, F.lit(None).cast(t))
        elif have[c] != T._parse_datatype_string(t):
            df = df.withColumn(c, _held(c, have[c], T._parse_datatype_string(t)))
    return df


def _count_row(check: str, table: str, n: DataFrame) -> DataFrame:
    return n.select(F.lit(check).alias("check"), F.lit(table).alias("table"),
                    F.coalesce(F.col("n").cast("bigint"), F.lit(0).cast("bigint")).alias("n_violations"))


def conforms(df: DataFrame, spec: TableSpec, tables: dict | None = None, schema: bool = False) -> DataFrame:
    """Violations of one table: ``check, table, n_violations``.
    Foreign keys are checked when the referenced table is in ``tables``.

    The rows of ``schema_rows`` are part of it where the columns differ from
    the spec, and always with ``schema=True``. The other checks then see the
    columns as declared: missing ones and values that don't fit are NULL."""
    out = []
    if schema or schema_problems(df, spec):
        out.append(schema_rows(df, spec))
        df = _as_declared(df, spec)
    if spec.primary_key:
        dup = df.groupBy(*spec.primary_key).agg(F.count(F.lit(1)).alias("__k")).filter("__k > 1")
        out.append(_count_row("pk_dup", spec.name, dup.agg(F.count(F.lit(1)).alias("n"))))
    row_checks = {}
    if spec.required:
        anynull = F.lit(False)
        for c in spec.required:
            anynull = anynull | F.col(c).isNull()
        row_checks["required_null"] = anynull
    if spec.ranges:
        bad = F.lit(False)
        for c, (lo, hi) in spec.ranges.items():
            v = F.col(c)
            if lo is not None:
                bad = bad | (v < F.lit(lo))
            if hi is not None:
                bad = bad | (v > F.lit(hi))
        row_checks["out_of_range"] = bad
    if row_checks:
        # all row-level checks of the table in one scan, then one row per check
        one = df.agg(*[F.sum(F.when(cond, 1).otherwise(0)).cast("bigint").alias(name)
                       for name, cond in row_checks.items()])
        long = one.unpivot([], list(row_checks), "check", "n")
        out.append(long.select("check", F.lit(spec.name).alias("table"),
                               F.coalesce(F.col("n"), F.lit(0).cast("bigint")).alias("n_violations")))
    for fk in spec.foreign_keys:
        if not tables or fk.ref_table not in tables:
            continue
        parent = tables[fk.ref_table].select(
            *[F.col(r).alias(c) for c, r in zip(fk.columns, fk.ref_columns)])
        child = df.select(*fk.columns).dropna()
        orphans = child.join(parent, list(fk.columns), "left_anti")
        out.append(_count_row("fk_orphan", f"{spec.name}->{fk.ref_table}",
                              orphans.agg(F.count(F.lit(1)).alias("n"))))
    if not out:
        raise ValueError(f"{spec.name}: spec declares nothing to check")
    res = out[0]
    for o in out[1:]:
        res = res.unionByName(o)
    return res


def reconcile(label: str, source: DataFrame, parts: Sequence[DataFrame]) -> DataFrame:
    """``rows`` check: |rows(source) - sum(rows(parts))|."""
    n = source.agg(F.count(F.lit(1)).alias("n"))
    diff = F.col("n")
    for p in parts:  # part counts enter as scalar subqueries (no join)
        diff = diff - p.agg(F.count(F.lit(1))).scalar()
    return _count_row("rows", label, n.select(F.abs(diff).alias("n")))


def verify(tables: dict, specs: Sequence[TableSpec],
           reconciliations: Sequence[tuple[str, str, Sequence[str]]] = (), schema: bool = False) -> DataFrame:
    """M5: all checks of all tables as ``check, table, n_violations``; a
    passing check yields 0. ``schema``: as for ``conforms``."""
    frames = [conforms(tables[s.name], s, tables, schema) for s in specs]
    frames += [reconcile(label, tables[src], [tables[p] for p in parts])
               for label, src, parts in reconciliations]
    res = frames[0]
    for f in frames[1:]:
        res = res.unionByName(f)
    return res


def seed_dimension(df: DataFrame, col: str, key: str = "key", value: str = "value") -> DataFrame:
    """M2: one row per distinct trimmed, non-empty value, keyed by md5."""
    v = F.trim(F.col(col).cast("string"))
    vals = df.select(v.alias(value)).filter(F.col(value).isNotNull() & (F.col(value) != "")).distinct()
    return vals.select(md5_key(value).alias(key), value)


def _nk_key(natural_key: Sequence[str]):
    if len(natural_key) == 1:
        return md5_key(natural_key[0])
    return F.md5(F.concat_ws("\u0001", *[F.trim(F.col(c).cast("string")) for c in natural_key]).cast("binary"))


def migrate_dimension(stage: DataFrame, natural_key: Sequence[str], attrs: Sequence[str],
                      order: Sequence[str], key: str = "key") -> DataFrame:
    """M3: one row per natural key; attributes from the row with the smallest
    ``order`` (then smallest attributes); ``n_variants`` = distinct attribute
    combinations, so conflicts are reported, not hidden. Text keys are trimmed
    before they are grouped; a row with a NULL or blank key part has no key
    and is left out. One aggregate: a hot natural key is combined map-side."""
    natural_key, attrs, order = list(natural_key), list(attrs), list(order)
    whole = F.lit(True)
    for c in natural_key:
        if isinstance(stage.schema[c].dataType, T.StringType):
            stage = stage.withColumn(c, F.trim(F.col(c)))
            whole = whole & (F.col(c) != "")
        whole = whole & F.col(c).isNotNull()
    pick = F.min(F.struct(*[F.col(c).alias(f"__o{i}") for i, c in enumerate(order)],
                          *[F.col(a).alias(a) for a in attrs]))
    g = stage.filter(whole) \
        .groupBy(*natural_key).agg(pick.alias("__p"),
                                   F.count_distinct(F.struct(*attrs)).cast("bigint").alias("n_variants"))
    return g.select(_nk_key(natural_key).alias(key), *natural_key,
                    *[F.col(f"__p.{a}").alias(a) for a in attrs], "n_variants")


def migrate_facts(stage: DataFrame, dims: Sequence[tuple[str, DataFrame, str, str, str]],
                  keep: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """M4: staging rows joined to every dimension.

    ``dims`` = ``(name, dimension, stage_col, dim_value_col, dim_key_col)``.
    Returns ``(facts, orphans)``: facts carry ``<name>_key`` for each
    dimension plus ``keep``; orphans carry the staging columns and
    ``missing_dim``, the first dimension without a match. Text is trimmed for
    the match, as the dimensions' values are. A dimension within the
    broadcast bounds is broadcast; the staging side is shuffled only for one
    that is larger."""
    x = stage
    for name, dim, scol, vcol, kcol in dims:
        d = broadcast_if_small(dim.select(F.col(vcol).alias(f"__v_{name}"), F.col(kcol).alias(f"{name}_key")), "dimension")
        own = F.trim(x[scol]) if isinstance(stage.schema[scol].dataType, T.StringType) else x[scol]
        x = x.join(d, own == d[f"__v_{name}"], "left").drop(f"__v_{name}")
    missing = F.lit(None).cast("string")
    for name, *_ in reversed(dims):
        missing = F.when(F.col(f"{name}_key").isNull(), F.lit(name)).otherwise(missing)
    x = x.withColumn("missing_dim", missing)
    facts = x.filter(F.col("missing_dim").isNull()).select(*[f"{n}_key" for n, *_ in dims], *keep)
    orphans = x.filter(F.col("missing_dim").isNotNull()).select(*stage.columns, "missing_dim")
    return facts, orphans
