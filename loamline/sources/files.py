"""Registry, manifest, blocklist and ledgers as files that Spark reads and writes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loamline.functions.text import blocklist_key
from loamline.operators.registry import CURATED, FIELDS, shard, shard_file
from loamline.session import checkpoint, remove_folder

_WINDOW = "struct<chars:bigint,alpha:double,words:bigint,cjk:bigint,en:bigint,domain:bigint>"
MANIFEST_SCHEMA = (
    "id string, title string, url string, source string, license string, topic string, format string, status string, "
    "http_status int, sha256 string, text_sha256 string, corpus_sha256 string, bytes bigint, text_chars bigint, corpus_chars bigint, "
    "raw_path string, text_path string, corpus_path string, error string, fetched_at timestamp, extractor_version string, cleaner_version string, "
    f"quality struct<total:bigint,w20:{_WINDOW},w100:{_WINDOW}>, language string, published_at string, jurisdiction string, document_type string, "
    "persistent_id string, license_url string, license_evidence string, rights_verified_at string"
)


def read_registry(spark: SparkSession, folder: str) -> DataFrame:
    """Entries of all shards with shard and pos: the curated shard first, the others by name."""
    import yaml

    files = spark.read.text(f"{folder}/*.yaml", wholetext=True).select(F.col("value"), F.regexp_extract(F.input_file_name(), r"([^/]+)\.yaml$", 1).alias("shard"))
    kind = f"array<struct<{', '.join(f'{f}:string' for f in FIELDS)}>>"

    @F.udf(kind)
    def parsed(text: str):
        rows = (yaml.safe_load(text) or {}).get("sources") or []
        return [tuple(None if r.get(f) is None else str(r[f]) for f in FIELDS) for r in rows]

    rows = files.select("shard", F.posexplode(parsed("value")).alias("n", "e")).select("shard", "n", "e.*")
    order = Window.orderBy(F.col("shard") != CURATED, "shard", "n")  # a registry's files, parsed on few tasks
    return rows.withColumn("pos", F.row_number().over(order)).drop("n")


def entry_yaml(entries: DataFrame) -> DataFrame:
    """id, yaml of each entry: fields in order, empty ones left out."""
    import yaml

    @F.udf("string")
    def dumped(row):
        kept = {f: row[f] for f in FIELDS if f in row and row[f] not in (None, "")}
        lines = yaml.safe_dump([kept], sort_keys=False, allow_unicode=True).splitlines()
        return "".join(f"  {line}\n" if line else "\n" for line in lines)

    present = [f for f in FIELDS if f in entries.columns]
    return entries.select("id", dumped(F.struct(*present)).alias("yaml"))


def read_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of all shards, as files of the folder or of folders by shard. Blank lines are left out.

    A line that is no JSON object of the schema, or has no id, is an error.
    """
    lines = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.json*").text(folder).where(F.trim("value") != "")
    rows = lines.select(F.from_json("value", MANIFEST_SCHEMA, {"mode": "FAILFAST"}).alias("row")).select("row.*")
    return rows.withColumn("id", F.coalesce("id", F.raise_error(F.lit("a manifest row without id")).cast("string")))


def write_manifest(rows: DataFrame, folder: str) -> DataFrame:
    """Makes a folder hold these rows by shard, sorted by topic and id; returns shard, change.

    Shards whose rows are the same stay untouched, those that have no row left are removed.
    """
    spark = rows.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    there = path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)
    typed = rows.select(*[(F.col(f.name).cast(f.dataType) if f.name in rows.columns else F.lit(None).cast(f.dataType)).alias(f.name) for f in T.StructType.fromDDL(MANIFEST_SCHEMA)])
    changes = checkpoint(changed_shards(read_manifest(spark, folder) if there else typed.limit(0), typed))
    named = {r["change"]: r["shards"] for r in changes.groupBy("change").agg(F.collect_list("shard").alias("shards")).collect()}  # a few dozen shards
    fresh = [*named.get("new", []), *named.get("changed", [])]
    if fresh:
        sharded = checkpoint(typed.withColumn("shard", shard(F.col("id"))).where(F.concat("shard", F.lit(".jsonl")).isin(fresh)))
        writer = sharded.repartition("shard").sortWithinPartitions("shard", "topic", "id").write
        writer.partitionBy("shard").mode("overwrite").option("partitionOverwriteMode", "dynamic").json(folder)
    for name in named.get("gone", []):
        remove_folder(spark, f"{folder}/shard={name.removesuffix('.jsonl')}")
    return changes


def changed_shards(before: DataFrame, after: DataFrame) -> DataFrame:
    """shard, change (changed, new, gone) by a fingerprint of each shard's rows, whatever their order."""
    def prints(rows: DataFrame, name: str) -> DataFrame:
        each = F.xxhash64(F.to_json(F.struct(*sorted(rows.columns)))).cast("decimal(20,0)")
        return rows.groupBy(shard_file(F.col("id")).alias("shard")).agg(F.struct(F.sum(each), F.count("*")).alias(name))

    both = prints(before, "a").join(prints(after, "b"), "shard", "full_outer")
    change = F.when(F.col("a").isNull(), "new").when(F.col("b").isNull(), "gone").when(F.col("a") != F.col("b"), "changed")
    return both.select("shard", change.alias("change")).where("change is not null")


def read_blocklist(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).select(blocklist_key(F.col("value")).alias("url")).where("url <> ''").distinct()


def append_blocklist(spark: SparkSession, path: str, urls: DataFrame) -> int:
    """Appends keys that are new, sorted; returns how many."""
    from loamline.operators.prune import blocklist_add

    try:
        have = read_blocklist(spark, path)
        have.schema
    except Exception as error:  # only a missing path means an empty blocklist
        if "PATH_NOT_FOUND" not in str(error):
            raise
        have = spark.createDataFrame([], "url string")
    new = blocklist_add(have, urls).orderBy("url").cache()
    n = new.count()
    if n:
        new.write.mode("append").text(path)
    new.unpersist()
    return n


def append_ledger(rows: DataFrame, path: str) -> None:
    """Appends rows as JSON lines, fields in sorted order."""
    rows.select(*sorted(rows.columns)).write.mode("append").json(path)


def run_event(spark: SparkSession, path: str, run_id: str, event: str, **fields: object) -> None:
    row = spark.range(1).select(F.lit(run_id).alias("run_id"), F.lit(event).alias("event"), F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("at"), F.create_map(*[F.lit(str(x)) for kv in sorted(fields.items()) for x in kv]).alias("fields") if fields else F.expr("cast(map() as map<string,string>)").alias("fields"))
    append_ledger(row, path)


def folder_usage(spark: SparkSession, folder: str) -> DataFrame:
    """One row: files, bytes."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder).select("length")
    return files.agg(F.count("*").alias("files"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"))


def signature(spark: SparkSession, *folders: str) -> str:
    """Fingerprint of the files' paths, sizes and times: what an index was made from.

    Sums of two hashes of each file stand for the set of files, so no list of them is made.
    """
    files = None
    for folder in folders:
        some = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder).select("path", "length", "modificationTime")
        files = some if files is None else files.unionByName(some)
    line = F.concat_ws("|", "path", F.col("length").cast("string"), F.unix_micros("modificationTime").cast("string"))
    hashed = lambda seed: F.sum(F.xxhash64(line, F.lit(seed)).cast("decimal(20,0)")).cast("string")
    row = files.agg(F.count("*").cast("string").alias("n"), hashed("a").alias("a"), hashed("b").alias("b")).select(F.sha2(F.concat_ws("|", "n", "a", "b"), 256))
    return row.first()[0]


def oversized(spark: SparkSession, folder: str, most: int = 80 << 20) -> DataFrame:
    """path, length of control files above the cap."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    return files.select("path", "length").where(F.col("length") > most)


def write_texts(rows: DataFrame, folder: str, ident: str = "id", text: str = "text") -> None:
    """Documents' texts (or cleaned texts) as a table by shard; only shards among the rows are replaced."""
    out = rows.select(F.col(ident).alias("id"), F.col(text).alias("text"), shard(F.col(ident)).alias("shard")).where("text is not null")
    out.repartition("shard").sortWithinPartitions("shard", "id").write.partitionBy("shard").mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(folder)


def read_texts(spark: SparkSession, folder: str) -> DataFrame:
    """id, text, shard."""
    return spark.read.schema("id string, text string, shard string").parquet(folder)


def export_texts(rows: DataFrame, folder: str, ident: str = "id", text: str = "text") -> DataFrame:
    """Writes one file <id>.md for each row, in a folder that all executors share; returns id, bytes.

    A file is written beside its place and moved there, so a task that runs again leaves the same.
    """
    def run(batches):
        import os

        import pyarrow as pa

        os.makedirs(folder, exist_ok=True)
        for batch in batches:
            sizes = []
            for name, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if name != os.path.basename(name) or name in ("", ".", ".."):
                    raise ValueError(f"an id that is no file name: {name!r}")
                data, place = (body or "").encode(), os.path.join(folder, f"{name}.md")
                beside = f"{place}.{os.getpid()}.part"
                with open(beside, "wb") as f:
                    f.write(data)
                os.replace(beside, place)
                sizes.append(len(data))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64())], ["id", "bytes"])

    return checkpoint(rows.select(F.col(ident).cast("string").alias("id"), F.col(text).alias("text")).mapInArrow(run, "id string, bytes long"))
