"""Small pieces that several corpus operators share."""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The six ASCII white space characters, x20 and x09 to x0D.
SPACES = " \t\n\x0b\x0c\r"
#: A word, for Java regular expressions and RE2.
WORD = r"[^\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(c: Column) -> Column:
    """A-Z in lower case, nothing else changed. lower() does the same to a
    text whose other characters are lower-case letters; translate(), several
    times slower, is kept for the rest."""
    others = c.rlike(r"[\x{80}-\x{10FFFF}&&[^\p{Ll}]]")
    plain = (F.octet_length(c) == F.length(c)) | ~others
    return F.when(plain, F.lower(c)).otherwise(F.translate(c, UPPER, UPPER.lower()))


def free_name(df: DataFrame, *names: str) -> list[str]:
    """The names, each with underscores in front until no column of df has it."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


def shielded(docs: DataFrame, names, operator) -> DataFrame:
    """operator(docs) with the columns of docs alone, for an operator that
    adds columns of these names: columns of docs with such a name bear another
    meanwhile, so that their own values come back."""
    taken = {n.lower() for n in names}
    clash = [c for c in docs.columns if c.lower() in taken]
    aside = dict(zip(clash, free_name(docs, *[f"_own_{c}" for c in clash]), strict=True))
    out = operator(docs.withColumnsRenamed(aside))
    return out.select(*[F.col(f"`{aside.get(c, c)}`").alias(c) for c in docs.columns])


#: Buckets by which first_rows() finds how far down the order it must read.
RANKED = 1 << 12


def first_rows(rows: DataFrame, key: str, late: Column, hashed: Column, n: int) -> DataFrame:
    """rows, narrowed to those that can be among the first n of their key in
    the order (late, hashed): late is a boolean, false first, hashed a 64-bit
    hash. Rows are counted by key and leading bits of the hash with partial
    sums, so that about n rows a key are left to rank, or one in RANKED of
    them, however large a key is."""
    lead = RANKED.bit_length() - 1
    bucket = F.shiftright(hashed, 64 - lead).cast("int") + F.lit(RANKED // 2) + F.when(late, RANKED).otherwise(0)
    placed = rows.withColumn("_at", bucket)
    counts = placed.groupBy(key, "_at").agg(F.count(F.lit(1)).alias("_n"))
    none = F.struct(F.lit(0).cast("long").alias("ahead"), F.lit(-1).alias("last"))
    further = lambda s, c: F.when(s["ahead"] < n, F.struct((s["ahead"] + c["_n"]).alias("ahead"), c["_at"].alias("last"))).otherwise(s)
    reach = counts.groupBy(key).agg(F.collect_list(F.struct("_at", "_n")).alias("_c"))
    reach = reach.select(key, F.aggregate(F.array_sort("_c"), none, further)["last"].alias("_last"))
    reach = checkpointed(reach)  # one row a key; known to be small, it narrows the rows before they are dealt by key
    return placed.join(small(reach, reach.count()), key).where("_at <= _last").drop("_at", "_last")


def bounded_batches(spark: SparkSession, rows: int = 2000) -> None:
    """Arrow batches of whole texts are held in the JVM and in Python at once; at most so many rows go into one."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key, "10000")) <= rows:
        spark.conf.set(key, str(rows))


def trim() -> None:
    """Give what a task has freed back to the system; workers live on, next to others, on the memory of one executor."""
    import ctypes

    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    libc = ctypes.CDLL(None)
    if hasattr(libc, "malloc_trim"):
        libc.malloc_trim(0)


#: Seconds between two trims of the driver, and when the last one was.
TRIM_EVERY, _trimmed = 3.0, [0.0]


def trim_driver(spark: SparkSession) -> None:
    """trim() for the driver: its Python, and its JVM, whose allocator keeps what planning and compiling have freed, some
    hundred MB. JVMs without the command are left as they are."""
    if time.monotonic() - _trimmed[0] < TRIM_EVERY:
        return
    _trimmed[0] = time.monotonic()
    trim()
    jvm, array = spark.sparkContext._jvm, spark.sparkContext._gateway.new_array
    of = jvm.java.lang.Class.forName
    beans = jvm.java.lang.management.ManagementFactory.getPlatformMBeanServer()

    def call(method: str, kinds: list[str], *args):
        # By reflection on the interface: the class of the server is not open to Py4J.
        types, values = array(jvm.java.lang.Class, len(kinds)), array(jvm.java.lang.Object, len(args))
        for k, (kind, arg) in enumerate(zip(kinds, args, strict=True)):
            types[k], values[k] = of(kind), arg
        return of("javax.management.MBeanServer").getMethod(method, types).invoke(beans, values)

    name = jvm.javax.management.ObjectName("com.sun.management:type=DiagnosticCommand")
    if not call("isRegistered", ["javax.management.ObjectName"], name):
        return
    known = call("getMBeanInfo", ["javax.management.ObjectName"], name).getOperations()
    if "systemTrimNativeHeap" in [o.getName() for o in known]:
        kinds = ["javax.management.ObjectName", "java.lang.String", "[Ljava.lang.Object;", "[Ljava.lang.String;"]
        call("invoke", kinds, name, "systemTrimNativeHeap", array(jvm.java.lang.Object, 0), array(jvm.java.lang.String, 0))


def map_texts(docs: DataFrame, make, fields: list[tuple[str, str]], text: str = "text", drop: tuple[str, ...] = ()) -> DataFrame:
    """Apply a batch function to the texts of docs, partition by partition.

    make() runs once per task and returns f(texts: Arrow string array) -> one
    list or array per field, in the order of fields, (name, SQL type) pairs.
    Columns of docs pass through, but for those in drop and those whose name
    clashes with a field. f sees runs of texts of bounded bytes.
    """
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructField, StructType, _parse_datatype_string

    from gridcheck.llm.wordhash import slices

    clash = {n.lower() for n, _ in fields} | {d.lower() for d in drop}
    keep = [c for c in docs.columns if c.lower() not in clash]
    own = text in keep and dict(docs.dtypes)[text] == "string"
    # Under plain numbers, as mapInArrow() can't take every name.
    columns = [F.col(f"`{c}`").alias(f"_{k}") for k, c in enumerate(keep)]
    if not own:
        columns.append(F.col(text).cast("string").alias(f"_{len(keep)}"))
    source = docs.select(*columns)
    n, at = len(keep), keep.index(text) if own else len(keep)
    schema = StructType([StructField(c, docs.schema[c].dataType, docs.schema[c].nullable) for c in keep])
    for name, kind in fields:
        schema = schema.add(name, _parse_datatype_string(kind))

    def run(batches):
        f = make()
        types = [x.type for x in to_arrow_schema(schema)]
        for whole in batches:
            for start, length in slices(whole.column(at)):
                batch = whole.slice(start, length)
                found = f(batch.column(at))
                out = [c if c.type == t else c.cast(t) for c, t in zip(batch.columns[:n], types, strict=False)]
                out += [pa.array(x, type=t) for x, t in zip(found, types[n:], strict=True)]
                yield pa.RecordBatch.from_arrays(out, names=schema.names)
        trim()

    bounded_batches(docs.sparkSession)
    return source.mapInArrow(run, schema)


def checkpointed(df: DataFrame) -> DataFrame:
    """df cut from its lineage and held in the folder of spark.checkpoint.dir,
    which all executors share. A folder of our own is set only where the
    session names none and runs on one machine."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        named = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if named is None:
            if not context.master.startswith("local["):
                raise ValueError("spark.checkpoint.dir is not set; a cluster needs a folder that all executors share")
            import tempfile

            named = tempfile.mkdtemp(prefix="checkpoints-")
        context.setCheckpointDir(named)
    out = df.checkpoint()
    trim_driver(df.sparkSession)
    return out


def small(df: DataFrame, rows: int, limit: int = 50_000) -> DataFrame:
    """df marked for broadcast if its counted rows allow it; else Spark joins it as it would any table."""
    return F.broadcast(df) if rows <= limit else df
