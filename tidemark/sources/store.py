"""A store on plain Parquet, in buckets by key, of which a batch rewrites what it touches."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Buckets of a new store, bytes of a bucket above which their number doubles, and files a bucket is written in.
BUCKETS = 64
BUCKET_BYTES = 64 << 20
FILES = 4
# Marks the row that keeps an emptied bucket in place.
EMPTIED = "_Deleted"
ROWS = "rows"


def _folder(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    at, files = _folder(spark, path)
    return files.exists(at)


def complete(spark: SparkSession, path: str) -> bool:
    """A job has finished writing this folder."""
    return exists(spark, f"{path}/_SUCCESS")


def listed(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if there is no such folder."""
    at, files = _folder(spark, path)
    return [s.getPath().getName() for s in files.listStatus(at)] if files.exists(at) else []


def dropped(spark: SparkSession, path: str) -> None:
    at, files = _folder(spark, path)
    files.delete(at, True)


@dataclass(frozen=True)
class BucketStore:
    """Rows in folders by a hash of their key. A batch reads and rewrites the buckets it touches, no others.

    A batch's new rows are staged under its number and then put in place by dynamic partition overwrite. A batch that
    comes again finds its staged rows complete and puts them in place once more, so it can't be applied twice; the staged
    rows of the batch before are dropped. A touched bucket that has no row left holds one mark, which readers don't see,
    so a deleted key leaves nothing behind.

    The number of buckets follows the size: ``grow`` doubles it when buckets have become too big, by writing the store
    anew beside the old one, which stays valid until the new one is complete. So a batch rewrites a bounded number of
    bytes per key it touches, however big the store becomes.
    """

    spark: SparkSession
    path: str
    keys: tuple[str, ...]
    buckets: int = BUCKETS
    bucket_bytes: int = BUCKET_BYTES

    def _layouts(self) -> dict[int, str]:
        """Folders of rows by their number of buckets; a doubled one counts once it is complete."""
        found = {}
        for name in listed(self.spark, self.path):
            if name == ROWS:
                found[self.buckets] = f"{self.path}/{name}"
            elif name.startswith(f"{ROWS}-") and complete(self.spark, f"{self.path}/{name}"):
                found[int(name.removeprefix(f"{ROWS}-"))] = f"{self.path}/{name}"
        return found

    def layout(self) -> tuple[int, str]:
        """Number of buckets and folder of the rows as they are now."""
        found = self._layouts()
        number = max(found, default=self.buckets)
        return number, found.get(number, f"{self.path}/{ROWS}")

    def bucket(self, number: int | None = None) -> Column:
        number = self.layout()[0] if number is None else number
        return F.pmod(F.xxhash64(*[F.col(k) for k in self.keys]), F.lit(number)).cast("int")

    def touched(self, rows: DataFrame) -> list[int]:
        """Buckets of the keys in ``rows``: at most as many numbers as there are buckets."""
        return sorted(r[0] for r in rows.select(self.bucket()).distinct().collect())

    def everything(self) -> list[int]:
        return list(range(self.layout()[0]))

    def read(self, touched: list[int] | None = None) -> DataFrame | None:
        """All rows, or those of some buckets; None before the first write."""
        _, folder = self.layout()
        if not exists(self.spark, folder):
            return None
        rows = self.spark.read.parquet(folder)
        if touched is not None:
            rows = rows.where(F.col("bucket").isin(touched))
        return rows.where(~F.col(EMPTIED)).drop("bucket", EMPTIED)

    def _staged(self, number: int | str) -> str:
        return f"{self.path}/staged/batch={number}"

    def is_staged(self, number: int | str) -> bool:
        return complete(self.spark, self._staged(number))

    def stage(self, rows: DataFrame, number: int | str, touched: list[int]) -> None:
        """Write down the whole new content of the buckets that batch ``number`` touches."""
        marks = self.spark.createDataFrame([(b,) for b in touched], "bucket int").withColumn(EMPTIED, F.lit(True))
        marked = rows.withColumn("bucket", self.bucket()).withColumn(EMPTIED, F.lit(False))
        marked.unionByName(marks, allowMissingColumns=True).write.mode("overwrite").parquet(self._staged(number))

    def staged_rows(self, number: int | str) -> DataFrame:
        """The rows a staged batch is about to put in place."""
        rows = self.spark.read.parquet(self._staged(number))
        return rows.where(~F.col(EMPTIED)).drop("bucket", EMPTIED)

    def put(self, number: int | str) -> None:
        """Put a staged batch in place; doing so again changes nothing."""
        new = self.spark.read.parquet(self._staged(number))
        self._write(new, self.layout()[1], "dynamic")
        for name in listed(self.spark, f"{self.path}/staged"):
            if name != f"batch={number}":
                dropped(self.spark, f"{self.path}/staged/{name}")
        number_now, folder = self.layout()
        for older, path in self._layouts().items():
            if older < number_now and path != folder:
                dropped(self.spark, path)

    def _write(self, rows: DataFrame, folder: str, mode: str) -> None:
        part = F.pmod(F.xxhash64(F.lit("file"), *[F.col(k) for k in self.keys]), F.lit(FILES))
        writer = rows.repartition(F.col("bucket"), part).write.mode("overwrite").option("partitionOverwriteMode", mode)
        writer.partitionBy("bucket").parquet(folder)

    def replace(self, rows: DataFrame, number: int | str, touched: list[int]) -> None:
        """Stage a batch, unless that is done, and put it in place."""
        if not self.is_staged(number):
            self.stage(rows, number, touched)
        self.put(number)

    def size(self) -> int:
        """Bytes of the rows, from the file system's books."""
        at, files = _folder(self.spark, self.layout()[1])
        return files.getContentSummary(at).getLength() if files.exists(at) else 0

    def grow(self) -> None:
        """Double the buckets until they are small enough on average. Only before a batch reads what it touches."""
        number, folder = self.layout()
        wanted = number
        while self.size() > wanted * self.bucket_bytes:
            wanted *= 2
        if wanted > number:
            rows = self.spark.read.parquet(folder).where(~F.col(EMPTIED)).drop("bucket")
            # Written whole, so that the folder is marked complete.
            self._write(rows.withColumn("bucket", self.bucket(wanted)), f"{self.path}/{ROWS}-{wanted}", "static")
