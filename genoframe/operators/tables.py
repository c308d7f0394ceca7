"""Column selection and editing (P), filters and checks (F)."""

from __future__ import annotations

import functools
import operator
import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from genoframe.operators.windows import exact_quantiles


def resolve(df: DataFrame, spec: str | Iterable) -> list[str]:
    """Column names of a spec: names, 0-based numbers and ranges ``a:b``, comma or semicolon between them."""
    items = re.split("[,;]", spec) if isinstance(spec, str) else list(spec)
    out: list[str] = []
    for item in map(str, items):
        if item in df.columns:
            out.append(item)
        elif m := re.fullmatch(r"(\d+):(\d+)", item):
            out += df.columns[int(m[1]) : int(m[2]) + 1]
        elif item.isdigit():
            out.append(df.columns[int(item)])
        else:
            raise ValueError(f"no column {item!r} among {df.columns}")
    return out


def _quoted(names: Iterable[str]) -> list[Column]:
    return [F.col(f"`{n}`") for n in names]


def select_cols(df: DataFrame, spec) -> DataFrame:
    """P1, P11"""
    return df.select(*_quoted(resolve(df, spec)))


def drop_cols(df: DataFrame, spec, then_select=None, first_select=None) -> DataFrame:
    """P2, and P3: columns dropped before (``then_select``) or after (``first_select``) a selection."""
    if first_select is not None:
        df = select_cols(df, first_select)
    gone = set(resolve(df, spec))
    df = df.select(*_quoted(c for c in df.columns if c not in gone))
    return select_cols(df, then_select) if then_select is not None else df


def reshuffle(df: DataFrame, to: list[int], source: list[int]) -> DataFrame:
    """Column number ``to[k]`` becomes what column ``source[k]`` was."""
    place = dict(zip(to, source, strict=True))
    return df.select(*(F.col(f"`{df.columns[place.get(k, k)]}`").alias(name) for k, name in enumerate(df.columns)))


def add_constants(df: DataFrame, at: dict[int, object]) -> DataFrame:
    """P5: constants ``C_k`` inserted at positions of the result."""
    names: list[Column] = _quoted(df.columns)
    for k, position in enumerate(sorted(at)):
        names.insert(position, F.lit(at[position]).alias(f"C_{k}"))
    return df.select(*names)


def set_header(df: DataFrame, names: dict[int, str]) -> DataFrame:
    """P6"""
    return df.toDF(*(names.get(k, c) for k, c in enumerate(df.columns)))


def edit_cols(df: DataFrame, cols, sql: str) -> DataFrame:
    """Each listed column becomes an expression in which ``_`` stands for it; ``"2:"`` lists all from number 2 on."""
    names = df.columns[int(cols[:-1]) :] if isinstance(cols, str) and re.fullmatch(r"\d+:", cols) else resolve(df, cols)
    return df.withColumns({n: F.expr(re.sub(r"\b_\b", f"`{n}`", sql)) for n in names})


def cols_to_front(df: DataFrame, cols) -> DataFrame:
    """P8"""
    first = resolve(df, cols)
    return df.select(*_quoted(first), *_quoted(c for c in df.columns if c not in first))


def header_table(df: DataFrame) -> DataFrame:
    """P9"""
    return df.sparkSession.createDataFrame([(k, c) for k, c in enumerate(df.columns)], "position int, name string")


def add_col(df: DataFrame, name: str, sql: str) -> DataFrame:
    """P10"""
    return df.withColumn(name, F.expr(sql))


def project_to(df: DataFrame, names: DataFrame, column: str = "name") -> DataFrame:
    """The columns that a table of names lists, in its order; more names than ``df`` has columns are an error."""
    listed = [r[0] for r in names.select(column).limit(len(df.columns) + 1).collect()]
    if len(listed) > len(df.columns):
        raise ValueError(f"more names than the table's {len(df.columns)} columns")
    return select_cols(df, listed)


def cols_like(df: DataFrame, include: str, exclude: str | None = None) -> DataFrame:
    """P13"""
    keep = [c for c in df.columns if re.search(include, c) and not (exclude and re.search(exclude, c))]
    return df.select(*_quoted(keep))


def reframe(df: DataFrame, header: dict[str, str] | None = None, casts: dict[str, str] | None = None, drop: Iterable[str] = (), values: dict[str, dict] | None = None, log: Iterable[str] = (), least: float = 0.0) -> DataFrame:
    """Rename, cast, map values, log-transform (values under ``least`` become null first), drop."""
    df = df.withColumnsRenamed(header or {})
    df = df.withColumns({c: F.col(f"`{c}`").cast(t) for c, t in (casts or {}).items()})
    for c, mapping in (values or {}).items():
        df = df.replace(mapping, subset=[c])
    df = df.withColumns({c: F.log(F.when(F.col(f"`{c}`") > least, F.col(f"`{c}`"))) for c in log})
    return df.drop(*drop)


def filter_in(df: DataFrame, col: str, ids: DataFrame, id_col: str | None = None) -> DataFrame:
    """F1, J10"""
    keys = ids.select(F.col(id_col or ids.columns[0]).alias(col)).distinct()
    return df.join(keys, col, "left_semi")


def exclude_ids(df: DataFrame, col: str, ids: DataFrame, id_col: str | None = None) -> DataFrame:
    """J11"""
    return df.join(ids.select(F.col(id_col or ids.columns[0]).alias(col)).distinct(), col, "left_anti")


def filter_expr(df: DataFrame, sql: str) -> DataFrame:
    """F2, F8: an expression that is null counts as false."""
    return df.filter(F.coalesce(F.expr(sql), F.lit(False)))


def filter_cols(df: DataFrame, pattern: str, predicate: str, how: str = "all") -> DataFrame:
    """a predicate (``_`` is the column) over all columns whose name matches."""
    tests = [F.coalesce(F.expr(re.sub(r"\b_\b", f"`{c}`", predicate)), F.lit(False)) for c in df.columns if re.search(pattern, c)]
    return df.filter(functools.reduce(operator.and_ if how == "all" else operator.or_, tests, F.lit(how == "all")))


def filter_rownum(df: DataFrame, line: str, numbers: Iterable[int | tuple[int, int]]) -> DataFrame:
    """rows whose line number is listed or lies in a listed range (both ends included)."""
    column = F.col(line)
    tests = [column.between(*n) if isinstance(n, tuple) else column == n for n in numbers]
    return df.filter(functools.reduce(operator.or_, tests, F.lit(False)))


def kept_rownums(df: DataFrame, line: str, sql: str) -> DataFrame:
    """F5"""
    return filter_expr(df, sql).select(line)


def filter_results(df: DataFrame, p: float = 1.0, r2: float = 0.4, maf: float = 0.02, beta: float = 1e4, marker_beta: float = 1e4, af: str = "allele_freq", info: str = "impute_info", pvalue: str = "p") -> DataFrame:
    """complete rows below P, within the frequency and information limits, all ``beta1*`` below ``beta``."""
    whole = functools.reduce(operator.and_, (F.col(f"`{c}`").isNotNull() for c in df.columns))
    kept = df.filter(whole).filter((F.col(pvalue) < p) & F.col(af).between(maf, 1 - maf) & (F.col(info) >= r2))
    kept = filter_cols(kept, r"^beta1", f"abs(_) < {beta}")
    return filter_cols(kept, r"^beta1\.marker", f"_ < {marker_beta}")


def complete_cases(df: DataFrame, variables: Iterable[str]) -> DataFrame:
    """F7"""
    return df.dropna(subset=list(variables))


def search_rows(df: DataFrame, record: dict) -> DataFrame:
    """F9"""
    return df.filter(functools.reduce(operator.and_, (F.col(c).eqNullSafe(F.lit(v)) for c, v in record.items())))


def nif(c: Column) -> Column:
    """null counts as false; ``nit``: as true; ``niz``: as 0; ``nina``: as a value."""
    return F.coalesce(c, F.lit(False))


def nit(c: Column) -> Column:
    return F.coalesce(c, F.lit(True))


def niz(c: Column) -> Column:
    return F.coalesce(c, F.lit(0))


def nina(c: Column, value: object) -> Column:
    return F.coalesce(c, F.lit(value))


def query(df: DataFrame, particles: dict[str, tuple[str, object]], distinct: bool = True, columns: Iterable[str] | None = None) -> DataFrame:
    """column particles (``=``, ``<``, ``>``, ``like``, ``raw``) joined by and; distinct rows unless told otherwise."""
    ops = {"=": operator.eq, "<": operator.lt, ">": operator.gt, "like": lambda c, v: c.like(v)}
    for name, (op, value) in particles.items():
        df = df.filter(F.expr(str(value)) if op == "raw" else ops[op](F.col(name), value))
    if columns:
        df = df.select(*columns)
    return df.distinct() if distinct else df


def select_qc(df: DataFrame, r2: float = 40, maf: float = 0.02, p: float = 1e-6, r2_col: str = "r2t", af_cols: tuple[str, ...] = ("af",), phenotype: str = "") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(all kept rows, lambda of the statistic, significant rows by falling statistic with the phenotype)."""
    kept = df.filter(F.col(r2_col) >= r2)
    for c in af_cols:
        kept = kept.filter(F.col(c).between(maf, 1 - maf))
    median = exact_quantiles(kept, F.col("stat"), [0.5])[0]
    lam = df.sparkSession.range(1).select((F.lit(median).cast("double") / 0.456).alias("lambda"))
    return kept, lam, kept.filter(F.col("p") <= p).withColumn("phenotype", F.lit(phenotype)).orderBy(F.desc("stat"))


def filter_topn(df: DataFrame, n: int, p: str = "p") -> DataFrame:
    """rows strictly below the N-th smallest P, rounded up at the ninth decimal."""
    nth = df.select(p).where(F.col(p).isNotNull()).orderBy(p).limit(n).agg(F.max(p).alias("x"))
    cut = nth.select((F.ceil(F.col("x") * 1e9) / 1e9).alias("__cut"))
    return df.join(F.broadcast(cut), F.col(p) < F.col("__cut")).drop("__cut")


def check_input(df: DataFrame, required: Iterable[str], id_col: str, sex_col: str | None = None, variables: Iterable[str] = ()) -> DataFrame:
    """one row of counts; raises on missing columns, repeated ids and sexes other than 1 and 2. Null ids are left out."""
    missing = set(required) | {id_col} | set(variables) | ({sex_col} if sex_col else set())
    if missing := missing - set(df.columns):
        raise ValueError(f"missing columns: {sorted(missing)}")
    known = df.where(F.col(id_col).isNotNull())
    whole = functools.reduce(operator.and_, (F.col(v).isNotNull() for v in variables), F.lit(True))
    tests = known.agg(F.count("*").alias("n"), F.count_distinct(id_col).alias("n_ids"), F.count_if(~F.col(sex_col).isin(1, 2) if sex_col else F.lit(False)).alias("bad_sex"), F.count_if(whole).alias("n_complete"))
    bad = (F.col("n") != F.col("n_ids")) | (F.col("bad_sex") > 0)
    return tests.withColumn("ok", F.when(bad, F.raise_error(F.concat(F.lit("input check: rows, ids, bad sexes "), F.concat_ws(",", "n", "n_ids", "bad_sex"))).cast("boolean")).otherwise(F.lit(True)))


def get_records(df: DataFrame, ids: DataFrame, key: str, most: int = 100_000) -> DataFrame:
    """F16: records of listed ids; an error when an id is missing or the list is too long."""
    wanted = ids.select(key).distinct()
    found = wanted.join(df.select(key).distinct().withColumn("__in", F.lit(True)), key, "left")
    stats = found.agg(F.count("*").alias("n"), F.count("__in").alias("k"))
    verdict = stats.select(F.when((F.col("n") > most) | (F.col("k") < F.col("n")), F.raise_error(F.format_string("%d ids asked for, %d found", "n", "k")).cast("boolean")).otherwise(F.lit(True)).alias("__ok"))
    return df.join(wanted, key, "left_semi").join(F.broadcast(verdict), F.col("__ok")).drop("__ok")


def with_line(df: DataFrame, order: list[str], name: str = "line") -> DataFrame:
    """A line number by ``order``, for tables that did not come with one."""
    from genoframe.operators.windows import global_rank

    return global_rank(df, order, name)

