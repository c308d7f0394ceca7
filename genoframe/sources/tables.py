"""Sources and sinks (SC)."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

GENS_INFO = "snp_id string, rs_id string, position long, a0 string, a1 string, exp_freq_a1 double, info double, certainty double, type int, info_type0 double, concord_type0 double, r2_type0 double"
#: Lines that the head of a prefixed table may have.
HEAD_LINES = 1000
FAM = "fid string, iid string, pid string, mid string, sex int, stat int"
BIM = "chr int, marker string, pos_gen double, pos long, a1 string, a2 string"


def read_table(spark: SparkSession, path: str | list[str], sep: str = "\t", header: bool = True, skip: int = 0, na: str = "NA", quote: str = '"', schema: str | None = None, multiline: bool = False) -> DataFrame:
    """SC1: all columns are strings unless a schema is given; ``na`` becomes null; ``skip`` lines at the head of each file are passed over."""
    reader = spark.read.options(sep=sep, nullValue=na, quote=quote, multiLine=multiline)
    if skip == 0:
        return (reader.schema(schema) if schema else reader).options(header=header).csv(path)
    if schema is None:
        raise ValueError("a schema is needed where lines are skipped")
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("__f"), F.col("_metadata.file_block_start").alias("__b"), F.monotonically_increasing_id().alias("__id"))
    # ids count lines within a split; the lines to skip are the first ones of the split that begins a file (one row a file)
    begin = lines.where("__b = 0").groupBy("__f").agg(F.min("__id").alias("__first"))
    kept = lines.join(begin, "__f", "left").where((F.col("__b") > 0) | (F.col("__id") >= F.col("__first") + (skip + 1 if header else skip)))
    return kept.select(F.from_csv("value", schema, {"sep": sep, "nullValue": na, "quote": quote}).alias("r")).select("r.*")


def parse_extended(spec: str) -> tuple[dict[str, str], str]:
    """``[A=x,B=y;z]:path`` to (options, path)."""
    m = re.fullmatch(r"\[(.*?)\]:(.*)", spec, re.S)
    return (dict(item.split("=", 1) for item in m[1].split(",") if item), m[2]) if m else ({}, spec)


def read_ext(spark: SparkSession, spec: str) -> DataFrame:
    """SC2: reader options in the path, applied in the order NAMES, HEADERMAP, PROJECT, complete cases, CONST, casts, DATEF, DELETE."""
    o, path = parse_extended(spec)
    sep = {"T": "\t", "S": " ", "C": ",", None: "\t"}.get(o.get("SEP"), o.get("SEP", "\t"))
    df = read_table(spark, path, sep, o.get("HEADER", "T") != "F", na=o.get("NA", "NA"))
    items = lambda k: [x for x in o.get(k, "").split(";") if x]
    pairs = lambda k: dict(x.split(":", 1) for x in items(k))
    if items("NAMES"):
        df = df.toDF(*items("NAMES"))
    df = df.withColumnsRenamed(pairs("HEADERMAP"))
    if items("PROJECT"):
        df = df.select(*items("PROJECT"))
    if o.get("COMPLETE") == "T":
        df = df.dropna()
    df = df.withColumns({k: F.lit(v) for k, v in pairs("CONST").items()})
    df = df.withColumns({c: F.col(c).cast("double") for c in items("NUMERIC")} | {c: F.col(c).cast("string") for c in items("AS_CHARACTER")})
    df = df.withColumns({c: F.to_timestamp(c, fmt) for c, fmt in pairs("DATEF").items()})
    return df.drop(*items("DELETE"))


def read_cols(spark: SparkSession, path: str, columns: dict[str, str], sep: str = "\t") -> DataFrame:
    """SC3: only the named columns, with their types; the header gives their places."""
    return spark.read.options(sep=sep, header=True, nullValue="NA").csv(path).select(*(F.col(c).cast(t).alias(c) for c, t in columns.items()))


def read_headed(spark: SparkSession, path: str, defaults: dict[str, str] | None = None) -> DataFrame:
    """SC4: separator guessed from the first line, quoted newlines kept, empty cells missing, then defaults."""
    first = spark.read.text(path).first()
    line = first[0] if first else ""
    sep = max(("\t", ";", ",", " "), key=line.count)
    return spark.read.options(sep=sep, header=True, multiLine=True, nullValue="", escape='"').csv(path).fillna(defaults or {})


def combine_files(spark: SparkSession, path: str, pattern: str, captures: dict[str, int], number: str | None = None, sep: str = "\t") -> DataFrame:
    """SC6: files of a folder whose path matches; captured groups become columns; ``number`` names the one to order by as a number."""
    df = spark.read.options(sep=sep, header=True, nullValue="NA", pathGlobFilter="*").csv(path).withColumn("__path", F.input_file_name())
    df = df.where(F.col("__path").rlike(pattern)).withColumns({name: F.regexp_extract("__path", pattern, k) for name, k in captures.items()}).drop("__path")
    return df.withColumn(number, F.col(number).cast("int")).orderBy(number) if number else df


def _lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, line from 1, value): ids count lines within a split of a file, splits follow one another by their place."""
    text = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("__at"), F.monotonically_increasing_id().alias("__id"), "value")
    splits = text.groupBy("file", "__at").agg(F.min("__id").alias("__first"), F.count("*").alias("__n"))
    before = Window.partitionBy("file").orderBy("__at").rowsBetween(Window.unboundedPreceding, -1)  # one row a split
    splits = splits.withColumn("__before", F.coalesce(F.sum("__n").over(before), F.lit(0)))
    return text.join(splits, ["file", "__at"]).select("file", (F.col("__before") + F.col("__id") - F.col("__first") + 1).alias("line"), "value")


def read_prefixed(spark: SparkSession, path: str | list[str], sep: str = "\t") -> tuple[dict[str, str], DataFrame]:
    """SC5: lines ``key: value`` until an empty line, then a table with header; empty lines in the table are passed over.

    Of a key that is there several times the last value counts. Each of several files has a head of its own; keys and names come from the first file by its path, and a file with other column names is an error. A head has
    ``HEAD_LINES`` lines at most and comes to the driver.
    """
    lines = _lines(spark, path)
    blank = lines.where("trim(value) = ''").groupBy("file").agg(F.min("line").alias("blank"))
    every = lines.join(blank, "file", "left")
    start = every.where(f"line <= {HEAD_LINES} and line <= coalesce(blank, {HEAD_LINES}) + 1")
    first = start.agg(F.min("file")).first()[0]
    head_lines = [r["value"] for r in start.where(F.col("file") == first).orderBy("line").collect()]
    at = next((k for k, line in enumerate(head_lines) if not line.strip()), None)
    if at is None or at + 1 >= len(head_lines):
        raise ValueError("no empty line after the key/value block, with a header behind it")
    head: dict[str, str] = {}
    for line in head_lines[:at]:
        key, _, value = line.partition(":")
        head[key.strip()] = value.strip()
    header = head_lines[at + 1]
    schema = T.StructType([T.StructField(n, T.StringType()) for n in header.split(sep)])
    same = F.when(F.col("value") == header, True).otherwise(F.raise_error(F.concat(F.lit("other columns in "), F.col("file"))).cast("boolean"))
    body = every.where(F.when(F.col("line") == F.col("blank") + 1, ~same).otherwise(F.coalesce(F.col("line") > F.col("blank"), F.lit(True)))).where("trim(value) <> ''")
    return head, body.select(F.from_csv("value", ", ".join(f"`{f.name}` string" for f in schema), {"sep": sep}).alias("r")).select("r.*")


def triples_of(numbers: Column) -> Column:
    """3N probabilities as an array of (p_aa, p_ab, p_bb)."""
    return F.transform(F.sequence(F.lit(0), (F.size(numbers) / 3).cast("int") - 1), lambda k: F.struct(numbers[3 * k].alias("p_aa"), numbers[3 * k + 1].alias("p_ab"), numbers[3 * k + 2].alias("p_bb")))


def read_gens(spark: SparkSession, path: str, info: str) -> DataFrame:
    """SC7: (snp_id, rs_id, position, a0, a1, k, p_aa, p_ab, p_bb): five id columns, then 3N probabilities; the name must equal that of the info file's line."""
    rows = _lines(spark, path).select("line", F.split("value", r"\s+").alias("c"))
    gens = rows.select("line", F.col("c")[0].alias("snp_id"), F.col("c")[1].alias("rs_id"), F.col("c")[2].cast("long").alias("position"), F.col("c")[3].alias("a0"), F.col("c")[4].alias("a1"), F.transform(F.slice("c", 6, F.size("c")), lambda x: x.cast("double")).alias("p"))
    named = _lines(spark, info).where("line > 1").select((F.col("line") - 1).alias("line"), F.split("value", r"\s+")[1].alias("name"))
    j = gens.join(named, "line", "left")
    checked = j.withColumn("rs_id", F.when(F.col("rs_id").eqNullSafe(F.col("name")), F.col("rs_id")).otherwise(F.raise_error(F.concat(F.lit("marker names differ in line "), F.col("line").cast("string")))))
    return checked.select("snp_id", "rs_id", "position", "a0", "a1", F.posexplode(triples_of(F.col("p"))).alias("k", "t")).select("snp_id", "rs_id", "position", "a0", "a1", "k", "t.*")


def read_gens_packed(spark: SparkSession, path: str) -> DataFrame:
    """SC8: alleles as ``A|B`` and the probabilities as one array; a triple with a missing value is an error."""
    c = F.split("value", r"\s+")
    rows = spark.read.text(path).select(c[0].alias("snp_id"), c[1].alias("rs_id"), c[2].cast("long").alias("position"), F.concat_ws("|", c[3], c[4]).alias("alleles"), F.transform(F.slice(c, 6, F.size(c)), lambda x: x.cast("double")).alias("p"))
    bad = F.exists("p", lambda x: x.isNull())
    return rows.withColumn("p", F.when(bad, F.raise_error(F.concat(F.lit("missing probability at "), F.col("rs_id"))).cast("array<double>")).otherwise(F.col("p")))


def read_gens_info(spark: SparkSession, paths: list[str]) -> DataFrame:
    """SC9: several info files or folders, with the file that a row came from and ``file_no``, the place of its path in the list, from 0."""
    context = spark.sparkContext
    places = [context._jvm.org.apache.hadoop.fs.Path(p) for p in paths]
    whole = [p.getFileSystem(context._jsc.hadoopConfiguration()).makeQualified(p).toUri().toString().rstrip("/") for p in places]
    bare = lambda c: F.regexp_replace(c, "^([a-z0-9]+):/+", "$1:/")  # noqa: E731  (one or three slashes behind the scheme)
    at = [F.when((bare(F.col("__path")) == bare(F.lit(w))) | F.startswith(bare(F.col("__path")), F.concat(bare(F.lit(w)), F.lit("/"))), k) for k, w in enumerate(whole)]
    rows = spark.read.schema(GENS_INFO).options(sep=" ", header=True, nullValue="NA").csv(paths).withColumn("__path", F.col("_metadata.file_path"))
    return rows.withColumns({"file": F.regexp_extract("__path", "([^/]+)$", 1), "file_no": F.coalesce(*at)}).drop("__path")


def read_fam(spark: SparkSession, path: str) -> DataFrame:
    """SC10"""
    return spark.read.schema(FAM).options(sep=" ").csv(path)


def read_bim(spark: SparkSession, path: str) -> DataFrame:
    """SC10"""
    return spark.read.schema(BIM).options(sep="\t").csv(path)


#: Bytes between two wanted markers that are read rather than skipped.
GAP_BYTES = 1 << 16


def spans(numbers: list[int], gap: int) -> list[tuple[int, int]]:
    """Ranges (first, count) of rising record numbers; neighbours with at most ``gap`` records between them are one range."""
    out: list[list[int]] = []
    for n in numbers:
        if out and n - out[-1][1] <= gap:
            out[-1][1] = n + 1
        else:
            out.append([n, n + 1])
    return [(a, b - a) for a, b in out]


def bed_markers(spark: SparkSession, bim: str) -> DataFrame:
    """SC11: (marker_no, marker, chr, pos, a1, a2): the markers of a bim file with their places in the packed file, from 0."""
    c = F.split("value", r"\s+")
    return _lines(spark, bim).select((F.col("line") - 1).alias("marker_no"), c[1].alias("marker"), c[0].cast("int").alias("chr"), c[3].cast("long").alias("pos"), c[4].alias("a1"), c[5].alias("a2"))


def read_bed(spark: SparkSession, bed: str, bim: DataFrame, fam: DataFrame, markers_at_once: int = 1000, only: DataFrame | None = None, flip: bool = False, called: bool = False) -> DataFrame:
    """SC11: (marker_no, person_no, gt) of the public packed format: after three magic bytes ceil(n / 4) bytes a marker, two bits a call,
    00 two copies of the first allele, 01 missing, 10 one, 11 none. Numbers are file order, from 0; missing calls are null.

    Tasks read ranges of ``markers_at_once`` markers by their place in the file, so that a large file is read by many of them; the bits are taken apart by
    numpy. With ``only`` (marker_no) nothing but these markers' bytes and small gaps between them are read; repeated numbers count once, and one that the file has not got is an error. With ``flip`` calls count the
    rarer allele (the first one where both are equally frequent), and ``flipped`` says where that is the other one. With ``called`` there are no rows of missing calls. A file whose length does not fit the two tables is an error.
    """
    import numpy as np
    import pyarrow as pa
    from pyarrow import fs

    people, markers = fam.count(), bim.count()
    width = -(-people // 4)
    fields = [("marker_no", pa.int64()), ("person_no", pa.int64()), ("gt", pa.int32()), *([("flipped", pa.bool_())] if flip else [])]
    out = pa.schema(fields)

    def run(batches):
        table = np.array([2, -1, 1, 0], np.int32)
        for batch in batches:
            for numbers in batch.column(0).to_pylist():
                if numbers[0] < 0 or numbers[-1] >= markers:
                    raise ValueError(f"the file has {markers} markers; asked for {numbers[0]} to {numbers[-1]}")
                store, path = fs.FileSystem.from_uri(bed) if "://" in bed else (fs.LocalFileSystem(), bed)
                wanted = set(numbers)
                with store.open_input_file(path) as source:
                    if source.read(3) != b"\x6c\x1b\x01" or source.size() != 3 + markers * width:
                        raise ValueError("not a marker-major packed genotype file of these markers and individuals")
                    for first, count in spans(numbers, GAP_BYTES // max(width, 1)):
                        source.seek(3 + first * width)
                        codes = np.frombuffer(source.read(count * width), np.uint8).reshape(count, width)
                        for k in (k for k in range(count) if first + k in wanted):
                            calls = table[(codes[k][:, None] >> np.array([0, 2, 4, 6], np.uint8)) & 3].ravel()[:people]
                            person = np.flatnonzero(calls >= 0) if called else np.arange(people)
                            if flip:
                                known = calls >= 0
                                turned = bool(calls[known].sum() > known.sum())
                                calls = np.where(known & turned, 2 - calls, calls)
                            calls = calls[person]
                            columns = [pa.array(np.full(len(person), first + k)), pa.array(person), pa.array(calls, pa.int32(), mask=calls < 0)]
                            yield pa.RecordBatch.from_arrays(columns + ([pa.array(np.full(len(person), turned))] if flip else []), schema=out)

    if only is None:
        starts = spark.range(0, markers, markers_at_once) if markers else spark.range(0)
        ranges = starts.select(F.sequence("id", F.least(F.col("id") + markers_at_once, F.lit(markers)) - 1).alias("numbers"))
    else:
        numbered = only.select(F.col("marker_no").cast("long").alias("n")).where("n is not null").distinct()
        ranges = numbered.groupBy(F.floor(F.col("n") / markers_at_once).alias("g")).agg(F.array_sort(F.collect_list("n")).alias("numbers")).select("numbers")
    return ranges.mapInArrow(run, "marker_no long, person_no long, gt int" + (", flipped boolean" if flip else ""))


def bed_records(gt: DataFrame, people: int) -> DataFrame:
    """SC11, the other way: (marker_no, data) with the packed calls of each marker of (marker_no, person_no, gt); absent calls are missing ones. A number of an individual beyond ``people`` or twice in a marker is an error."""
    import numpy as np
    import pyarrow as pa

    width = -(-people // 4)

    def pack(table: pa.Table) -> pa.Table:
        person, call = table.column("person_no").to_numpy(), table.column("code").to_numpy()
        if len(person) and (person.min() < 0 or person.max() >= people or len(np.unique(person)) < len(person)):
            raise ValueError("individuals of a marker must be different numbers below their total")
        codes = np.zeros(4 * width, np.uint8)
        codes[:people] = 1
        codes[person] = call
        four = codes.reshape(-1, 4)
        return pa.table({"marker_no": table.column("marker_no")[:1], "data": pa.array([(four[:, 0] | four[:, 1] << 2 | four[:, 2] << 4 | four[:, 3] << 6).tobytes()], pa.binary())})

    code = F.when(F.col("gt") == 2, 0).when(F.col("gt") == 1, 2).when(F.col("gt") == 0, 3).otherwise(1)
    calls = gt.select(F.col("marker_no").cast("long").alias("marker_no"), F.col("person_no").cast("long").alias("person_no"), code.cast("byte").alias("code"))
    return calls.groupBy("marker_no").applyInArrow(pack, "marker_no long, data binary")


def join_id_files(spark: SparkSession, templates: list[str], values: dict[str, list[str]], column: int = 0, sep: str = "\t") -> DataFrame:
    """Distinct ids of a column of all files that the templates (``{name}`` filled in with each of the values) lead to; absent and empty files are passed over."""
    import itertools

    paths = [t.format(**dict(zip(values, combination, strict=True))) for t in templates for combination in itertools.product(*values.values())]
    context = spark.sparkContext
    there = []
    for path in dict.fromkeys(paths):
        place = context._jvm.org.apache.hadoop.fs.Path(path)
        if place.getFileSystem(context._jsc.hadoopConfiguration()).globStatus(place):
            there.append(path)
    if not there:
        return spark.createDataFrame([], "id string")
    cell = F.get(F.split("value", sep), F.lit(column))
    return spark.read.text(there).select(F.trim(cell).alias("id")).where("id <> ''").distinct()


def export_clean(df: DataFrame, components: DataFrame | None, excluded: DataFrame, markers_excluded: DataFrame, prefix: str, key: str = "id") -> dict[str, str]:
    """SC26: variables of the individuals that are not excluded, with their scaling components, and the lists of individuals in and out and of excluded
    markers, each as CSV below ``prefix``; gives the paths. Individuals without components keep nulls."""
    whole = df if components is None else df.join(components, key, "left")
    kept = whole.join(excluded.select(F.col("id").alias(key)).distinct(), key, "left_anti")
    tables = {
        "individuals-excluded": excluded.select("id").distinct(), "individuals-included": kept.select(key).distinct(), "variables": kept,
        "markers-excluded": markers_excluded.select("id").distinct(),
    }
    paths = {}
    for name, table in tables.items():
        paths[name] = f"{prefix}-{name}.csv"
        write_table(table, [paths[name]], sep=",")
    return paths


def add_map(folder: str, chart: DataFrame, source: str, version: str, overwrite: bool = False) -> None:
    """SC20: writes the map below ``folder``; one that is there is an error, or with ``overwrite`` it is kept as ``map-backup``. A row of metadata is added."""
    spark = chart.sparkSession
    context = spark.sparkContext
    place, backup = (context._jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}") for name in ("map", "map-backup"))
    store = place.getFileSystem(context._jsc.hadoopConfiguration())
    if store.exists(place):
        if not overwrite:
            raise ValueError(f"there is a map in {folder} already")
        store.delete(backup, True)
        store.rename(place, backup)
    chart.write.parquet(f"{folder}/map")
    spark.createDataFrame([("map", source, version)], "table string, source string, version string").write.mode("append").parquet(f"{folder}/metadata")


def write_table(df: DataFrame, paths: list[str], columns: list[str] | None = None, sep: str = "\t", header: bool = True, quote: bool = False, decimal: str = ".", mode: str = "overwrite") -> None:
    """SC15, SC16: to several paths; the ending (.gz, .bz2) gives the compression; ``decimal`` replaces the point of doubles."""
    out = df.select(*columns) if columns else df
    if decimal != ".":
        out = out.withColumns({c: F.replace(F.col(c).cast("string"), F.lit("."), F.lit(decimal)) for c, t in out.dtypes if t in ("double", "float")})
    for path in paths:
        kind = {"gz": "gzip", "bz2": "bzip2"}.get(path.rsplit(".", 1)[-1], "none")
        out.write.mode(mode).options(sep=sep, header=header, quoteAll=quote, compression=kind, nullValue="NA").csv(path)


def sample_rows(df: DataFrame, ids: list[str], types: dict[str, str]) -> DataFrame:
    """SC12: rows as text with the type row (0 for ids, then C, D, P, B) first; ``line`` orders them."""
    cols = [*ids, *types]
    head = df.sparkSession.createDataFrame([(0, *(["0"] * len(ids)), *types.values())], "line long, " + ", ".join(f"`{c}` string" for c in cols))
    body = df.select(F.lit(1).cast("long").alias("line"), *(F.coalesce(F.col(c).cast("string"), F.lit("NA")).alias(c) for c in cols))
    return head.unionByName(body)


def write_sample(df: DataFrame, ids: list[str], types: dict[str, str], path: str) -> None:
    """SC12, SC13: one file with two header rows."""
    rows = sample_rows(df, ids, types)
    rows.coalesce(1).sortWithinPartitions("line", ids[0]).drop("line").write.mode("overwrite").options(sep=" ", header=True).csv(path)


def sex_rows(df: DataFrame) -> DataFrame:
    """SC13: ID_1 ID_2 missing sex."""
    return df.select(F.col("fid").alias("ID_1"), F.col("iid").alias("ID_2"), F.lit(0).alias("missing"), "sex")


def variables_table(variables: DataFrame, ped: DataFrame, columns: list[str]) -> DataFrame:
    """SC14: the pedigree's ids in front, then the listed variables."""
    return ped.select("fid", "iid").join(variables.drop("fid"), "iid", "left").select("fid", "iid", *columns)


def csv_to_table(df: DataFrame, path: str, columns: dict[str, str], types: dict[str, str], index: list[str], unique: list[str] | None = None) -> DataFrame:
    """SC17, SC18, R13: columns picked and renamed, typed, written sorted by the index columns; a repeated unique key is an error."""
    out = df.select(*(F.col(c).cast(types.get(n, dict(df.dtypes)[c])).alias(n) for c, n in columns.items()))
    if unique and not out.groupBy(*unique).count().where("count > 1").isEmpty():
        raise ValueError(f"{unique} is not unique")
    out.repartitionByRange(*index).sortWithinPartitions(*index).write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def variant_db(gens: DataFrame, result: DataFrame, source: str) -> dict[str, DataFrame]:
    """SC19, SC20: the tables data, map, qc, result and metadata with ids by chromosome and position."""
    from genoframe.operators.windows import global_rank

    ids = global_rank(gens.select("chrom", "start", "name", "alleles").distinct(), ["chrom", "start", "name"], "gvar_id")
    data = gens.join(ids, ["chrom", "start", "name", "alleles"]).select("gvar_id", F.lit("imputed").alias("gvar_meas"), "gvar_data", F.col("alleles").alias("gvar_allele"))
    chart = ids.select("gvar_id", "chrom", F.col("start").cast("double"), F.col("start").cast("double").alias("end"), F.col("name").alias("gvar_name"), F.lit("+").alias("strand"))
    meta = gens.sparkSession.createDataFrame([("map", source)], "table string, source string")
    return {"data": data, "map": chart, "result": result.join(ids.select("gvar_id", "name"), "name"), "metadata": meta}


def validate_db(db: dict[str, DataFrame], lengths: bool = False) -> DataFrame:
    """SC21: one row of counts per table: rows, distinct ids, nulls, range of ids, and with ``lengths`` whether it is as long as the map (``fits``); missing tables or id columns are errors."""
    if missing := {"data", "map"} - db.keys():
        raise ValueError(f"missing tables: {sorted(missing)}")
    out = None
    for name, df in sorted(db.items()):
        if name == "metadata":
            continue
        if "gvar_id" not in df.columns:
            raise ValueError(f"{name} has no gvar_id")
        row = df.agg(F.lit(name).alias("name"), F.count("*").alias("n"), F.count_distinct("gvar_id").alias("ids"), F.count_if(F.col("gvar_id").isNull()).alias("nulls"), F.min("gvar_id").alias("least"), F.max("gvar_id").alias("most"))
        out = row if out is None else out.unionByName(row)
    if not lengths:
        return out
    length = out.where("name = 'map'").select(F.col("n").alias("__n"))
    return out.join(F.broadcast(length)).withColumn("fits", F.col("n") == F.col("__n")).drop("__n")


def normalize_map(chart: DataFrame, data: DataFrame) -> DataFrame:
    """SC28: map rows of data rows, ``map_incl`` the rank of usable rows (known chromosome and strand, bi-allelic) in genome order, else 0."""
    rank = F.when(F.col("chrom").rlike(r"^\d+$"), F.col("chrom").cast("int")).when(F.col("chrom") == "X", 23).when(F.col("chrom") == "Y", 24)
    usable = (rank <= 24) & F.col("strand").isin("+", "-") & F.col("gvar_allele").rlike(r"^[ACGT]\|[ACGT]$")
    rows = data.select("gvar_id", "gvar_allele").join(chart, "gvar_id", "left").withColumns({"__rank": rank, "__use": F.coalesce(usable, F.lit(False))})
    from genoframe.operators.windows import global_rank

    ranked = global_rank(rows.where("__use"), ["__rank", "start", "gvar_id"], "map_incl").select("gvar_id", "map_incl")
    return rows.join(ranked, "gvar_id", "left").withColumn("map_incl", F.coalesce("map_incl", F.lit(0))).drop("__rank", "__use")


def inject(spark: SparkSession, folders: list[str], pattern: str, names: list[str], unique: bool = False) -> DataFrame:
    """SC22: files of folders that match, with captures as columns; contents are not read."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folders).select("path", "length")
    kept = listed.where(F.col("path").rlike(pattern)).select("path", "length", *(F.regexp_extract("path", pattern, k + 1).alias(n) for k, n in enumerate(names)))
    return kept.dropDuplicates(names) if unique else kept


def union_specs(specs: dict[str, DataFrame], relocate: tuple[str, str] | None = None) -> DataFrame:
    """SC23: file tables together, paths moved, the source as suffix of the name."""
    import functools

    every = functools.reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), (f.withColumn("source", F.lit(s)) for s, f in specs.items()))
    return every.withColumn("path", F.regexp_replace("path", *relocate)) if relocate else every


def probe_columns(spark: SparkSession, paths: list[str], sep: str = "\t") -> DataFrame:
    """SC25: number of columns in the first line of each file."""
    lines = spark.read.text(paths).select(F.input_file_name().alias("file"), F.monotonically_increasing_id().alias("id"), F.size(F.split("value", sep)).alias("n"))
    return lines.groupBy("file").agg(F.min_by("n", "id").alias("n"))


def dataset_meta(df: DataFrame, templates: dict[str, tuple[str, str]]) -> DataFrame:
    """SC27: (column, type, full type) by the first template whose pattern matches the name."""
    rows = []
    for c in df.columns:
        found = next((v for p, v in templates.items() if re.fullmatch(p, c)), ("unknown", "unknown"))
        rows.append((c, *found))
    return df.sparkSession.createDataFrame(rows, "column string, type string, full_type string")


def transform_columns(df: DataFrame, templates: dict[str, str]) -> DataFrame:
    """SC27: columns whose name one template's pattern is found in (without regard to case), and one only, go through its expression, in which ``{x}`` stands for the column."""
    edits = {}
    for c in df.columns:
        found = [e for p, e in templates.items() if re.search(p, c, re.I)]
        if len(found) == 1:
            edits[c] = F.expr(found[0].replace("{x}", f"`{c}`"))
    return df.withColumns(edits)
