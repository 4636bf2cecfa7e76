"""Session defaults, and tables that cut a long plan's lineage."""

from __future__ import annotations

import shutil
import tempfile
import uuid
import zipfile
from importlib.resources import files
from pathlib import Path

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType


def build(master: str = "local[8]", app: str = "weftline", **conf: str) -> SparkSession:
    """A local session with the settings the tests and the benchmark use; on a cluster the submitter's settings hold."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "8g",
    } | conf
    return SparkSession.builder.master(master).appName(app).config(map=settings).getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: `spark.checkpoint.dir`. Only a local session may go without it."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="spark-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def ship(spark: SparkSession) -> None:
    """Sends this package to the session's Python workers, once: tasks import it wherever the driver was started."""
    sc = spark.sparkContext
    if not getattr(sc, "_weftline_sent", False):
        home = Path(__file__).resolve().parent
        made = shutil.make_archive(f"{tempfile.mkdtemp(prefix='spark-')}/{home.name}", "zip", home.parent, home.name)
        sc.addPyFile(made)
        sc._weftline_sent = True


def java_function(spark: SparkSession, file: str, class_: str, name: str, returns: str, vector: tuple[str, str] | None = None) -> None:
    """Registers a Java UDF of this package as the SQL function `name`. Janino, which every Spark has, compiles its source once a context; executors get it as a jar.

    `vector` is the file and class that take the place of the first, which they extend, where the JVM has its vector module: Spark
    starts drivers and executors with it.
    """
    sc, jvm = spark.sparkContext, spark._jvm
    made = sc.__dict__.setdefault("_weftline_java", {})
    if class_ not in made:
        loader, codes = jvm.java.lang.Thread.currentThread().getContextClassLoader(), {}
        use = vector and jvm.java.lang.ModuleLayer.boot().findModule("jdk.incubator.vector").isPresent()
        for source in [file, vector[0]] if use else [file]:
            compiler = jvm.org.codehaus.janino.SimpleCompiler()
            compiler.setParentClassLoader(loader)
            compiler.cook((files(__package__) / source).read_text(encoding="utf-8"))
            loader, of = compiler.getClassLoader(), compiler.getBytecodes()
            codes |= {k: bytes(of.get(k)) for k in of.keySet()}
        jar = f"{tempfile.mkdtemp(prefix='spark-')}/{name}.jar"
        with zipfile.ZipFile(jar, "w") as z:
            for k, code in codes.items():
                z.writestr(f"{k.replace('.', '/')}.class", code)
        sc._jsc.addJar(jar)
        none = lambda of: sc._gateway.new_array(of, 0)
        made[class_] = loader.loadClass(vector[1] if use else class_).getDeclaredConstructor(none(jvm.java.lang.Class)).newInstance(none(jvm.java.lang.Object))
    kind = DataType.fromDDL(returns)
    spark._jsparkSession.udf().register(name, made[class_], spark._jsparkSession.parseDataType(kind.json()))


class Scratch:
    """Tables written to the shared folder by one run of an iterative operator.

    A written table survives lost executors and starts a new plan; `drop` removes one that a later round replaced.
    Tables a result still reads stay until `clear_scratch`, or until the cluster clears its checkpoint folder.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.folder, self.n = spark, f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex[:12]}", 0
        spark.sparkContext.__dict__.setdefault("_weftline_scratch", []).append(self.folder)

    def write(self, df: DataFrame, **metrics) -> DataFrame | tuple[DataFrame, dict]:
        """Write df and read it back. With metrics (name=aggregate Column) also their values, observed on the way."""
        self.n += 1
        path = f"{self.folder}/{self.n:04d}"
        seen = Observation() if metrics else None
        if seen:
            df = df.observe(seen, *(c.alias(k) for k, c in metrics.items()))
        df.write.parquet(path)
        table = self.spark.read.schema(df.schema).parquet(path)
        table._scratch_path = path
        return (table, seen.get) if seen else table

    def drop(self, *tables: DataFrame) -> None:
        jvm = self.spark._jvm
        for t in tables:
            path = jvm.org.apache.hadoop.fs.Path(t._scratch_path)
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def count_rows() -> Column:
    return F.count(F.lit(1))


def clear_scratch(spark: SparkSession) -> None:
    """Deletes all tables this session's operators wrote to the shared folder. Results not written elsewhere by then are lost."""
    folders = spark.sparkContext.__dict__.pop("_weftline_scratch", [])
    for folder in folders:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
