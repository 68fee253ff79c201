"""Cutting the lineage of iterative jobs with tables written to the shared folder.

The folder is the one the cluster names in ``spark.checkpoint.dir``.  A written table is
preferred to ``checkpoint()`` because the reader keeps column pruning and exact sizes,
which lets Spark re-decide broadcast or shuffle in every round from measured bytes.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_CLAVE = "spark.checkpoint.dir"


#: Bytes of one bucket of a table that a loop joins again and again.
BYTES_POR_CUBETA = 128 << 20
_BASE = "comanda_cortes"


def carpeta_compartida(spark: SparkSession) -> str:
    """The cluster's folder; where none is named in a local session, one beside the tables.  A cluster must name one:
    a folder of the driver's machine is not one that executors reach."""
    base = spark.conf.get(_CLAVE, None)
    if not base:
        if not spark.conf.get("spark.master", "local").startswith("local"):
            raise ValueError(f"set {_CLAVE} to a folder that all executors share")
        base = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_cortes"
        spark.conf.set(_CLAVE, base)
    return base


#: What the open ``trabajo`` blocks have written: folders, tables and databases, innermost block last.
_TRABAJOS: list[list[tuple[str, str]]] = []


def anotar(clase: str, nombre: str) -> str:
    """Notes a folder (``ruta``), ``TABLE`` or ``DATABASE`` that goes when the open ``trabajo`` block ends."""
    if _TRABAJOS:
        _TRABAJOS[-1].append((clase, nombre))
    return nombre


@contextmanager
def trabajo(spark: SparkSession) -> Iterator[None]:
    """Removes, after success and after failure, everything that operators have written within the block for themselves.

    Results are read from such tables, so they must be written elsewhere or collected inside.  Without a block the tables
    stay, since nobody but the caller knows when a result has been read.
    """
    _TRABAJOS.append([])
    try:
        yield
    finally:
        for clase, nombre in reversed(_TRABAJOS.pop()):
            if clase == "ruta":
                _borrar(spark, nombre)
            else:
                spark.sql(f"DROP {clase} IF EXISTS {nombre}" + (" CASCADE" if clase == "DATABASE" else ""))


class Corte:
    """One iterative job: each ``guardar`` writes a table and returns it with its row count, or with None where nobody
    asks for the count, which is a job of its own."""

    def __init__(self, spark: SparkSession, nombre: str):
        self.spark = spark
        self.nombre = f"{nombre}_{uuid.uuid4().hex}"
        self.raiz = anotar("ruta", f"{carpeta_compartida(spark)}/{self.nombre}")
        self.n = 0
        self.estado: str | None = None
        self.por_clave: list[tuple[str, str]] = []

    def _ruta(self) -> str:
        self.n += 1
        return f"{self.raiz}/{self.n:05d}"

    def guardar(self, df: DataFrame, contar: bool = True) -> tuple[DataFrame, int | None]:
        ruta = self._ruta()
        df.write.parquet(ruta)
        leido = self.spark.read.schema(df.schema).parquet(ruta)
        # answered from the file footers, no data pages are read
        return leido, leido.count() if contar else None

    def avanzar(self, df: DataFrame, contar: bool = True) -> tuple[DataFrame, int | None]:
        """Writes the next state of a loop.  It holds everything later rounds need, so the
        state before it is removed and a long loop keeps one state on disk, not all of them."""
        anterior = self.estado
        leido, n = self.guardar(df, contar)
        self.estado = f"{self.raiz}/{self.n:05d}"
        if anterior:
            _borrar(self.spark, anterior)
        return leido, n

    def guardar_por_clave(self, df: DataFrame, claves: list[str]) -> DataFrame:
        """Writes a table that every round joins on ``claves``, bucketed by them: each round
        shuffles the state to it and never shuffles the table again.  The buckets follow the size."""
        df, _ = self.guardar(df, contar=False)
        bruto = f"{self.raiz}/{self.n:05d}"
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {_BASE}")
        ruta, tabla = self._ruta(), f"{_BASE}.{self.nombre}_{self.n:05d}"
        cubetas = max(int(self.spark.conf.get("spark.sql.shuffle.partitions")),
                      -(-_largo(self.spark, bruto) // BYTES_POR_CUBETA))
        anotar("TABLE", tabla)
        (df.repartition(cubetas, *claves).write.bucketBy(cubetas, *claves).format("parquet")
         .option("path", ruta).saveAsTable(tabla))
        self.por_clave.append((tabla, ruta))
        _borrar(self.spark, bruto)
        return self.spark.table(tabla)

    def cerrar(self) -> None:
        """Drops the bucketed tables, once the last state that reads them is written."""
        for tabla, ruta in self.por_clave:
            self.spark.sql(f"DROP TABLE IF EXISTS {tabla}")
            _borrar(self.spark, ruta)
        self.por_clave = []


def _largo(spark: SparkSession, ruta: str) -> int:
    p = spark._jvm.org.apache.hadoop.fs.Path(ruta)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(p).getLength()


def _borrar(spark: SparkSession, ruta: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(ruta)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
