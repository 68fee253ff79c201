"""Stored tables that later loads are merged into by key.

A table is a folder of buckets by key hash and one small file a version, which names for every bucket the version that
wrote it.  A merge writes the buckets that hold a new or different row, and nothing else, into a folder of its own; then
the file of the next version is moved into place.  Until then readers see the version before, whole, and a load that
fails leaves files that no version names.  The file cannot be moved over one that is there, so of two loads at a time one
fails and can be repeated.

The driver holds one entry a bucket.  Keys are dealt out by hash and one key is one row, so no bucket is hot.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CUBETAS = 64


def _fs(spark: SparkSession, ruta: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(ruta)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def version(spark: SparkSession, ruta: str) -> dict | None:
    """The latest version: number, keys, columns, bucket count, and the version of each bucket that has rows."""
    fs, p = _fs(spark, f"{ruta}/versiones")
    if not fs.exists(p):
        return None
    nombres = [x.getPath().getName() for x in fs.listStatus(p)]
    ultima = max((n for n in nombres if n.endswith(".json") and not n.startswith("_")), default=None)
    if ultima is None:
        return None
    return json.loads("\n".join(f["value"] for f in spark.read.text(f"{ruta}/versiones/{ultima}").collect()))


def _publicar(spark: SparkSession, ruta: str, v: dict) -> None:
    fs, carpeta = _fs(spark, f"{ruta}/versiones")
    fs.mkdirs(carpeta)
    _, borrador = _fs(spark, f"{ruta}/versiones/_{uuid.uuid4().hex}")
    salida = fs.create(borrador, False)
    salida.write(bytearray(json.dumps(v).encode()))
    salida.close()
    _, final = _fs(spark, f"{ruta}/versiones/{v['numero']:010d}.json")
    if fs.exists(final) or not fs.rename(borrador, final):
        fs.delete(borrador, False)
        raise RuntimeError(f"{ruta}: another load has written version {v['numero']}")


def _leer(spark: SparkSession, ruta: str, v: dict, cubetas: list[int] | None = None) -> DataFrame:
    tipos = T.StructType.fromJson(v["esquema"])
    rutas = [f"{ruta}/datos/{carpeta}/_c={c}" for c, carpeta in v["cubetas"].items() if cubetas is None or int(c) in cubetas]
    return spark.read.schema(tipos).parquet(*rutas) if rutas else spark.createDataFrame([], tipos)


def leer(spark: SparkSession, ruta: str) -> DataFrame:
    """The rows of the latest version."""
    v = version(spark, ruta)
    if v is None:
        raise ValueError(f"no table is stored in {ruta}")
    return _leer(spark, ruta, v)


def fusionar(df: DataFrame, ruta: str, claves: list[str], orden: Column | None = None, solo_crear: bool = False,
             cubetas: int = CUBETAS) -> int:
    """Merges ``df`` into the table of ``ruta`` and returns its version, the one before if nothing has changed.

    A row replaces the stored row of its key; ``solo_crear`` leaves stored rows as they are.  Of several new rows of one
    key the greatest by ``orden`` counts, then the greatest row.  Nulls in keys equal each other.  ``cubetas`` is read
    when the table is made; keys and columns are those of the first load.
    """
    spark = df.sparkSession
    v = version(spark, ruta)
    if v is None:
        v = {"numero": 0, "claves": claves, "esquema": df.schema.jsonValue(), "n": cubetas, "cubetas": {}}
    tipos = T.StructType.fromJson(v["esquema"])
    if v["claves"] != claves or [(c.name, c.dataType) for c in tipos] != [(c.name, c.dataType) for c in df.schema]:
        raise ValueError(f"{ruta} is stored with keys {v['claves']} and columns {tipos.simpleString()}")
    fila = lambda d: F.struct(*[d[f"`{c}`"] for c in tipos.names])
    llave = lambda x: F.struct(*[x.getField(c) for c in claves])
    cubeta = lambda x: F.pmod(F.xxhash64(*[x.getField(c) for c in claves]), F.lit(v["n"])).cast("int")
    f = fila(df)
    nuevas = (df.select(f.alias("_f"), F.struct(F.lit(None) if orden is None else orden, f).alias("_o"))
              .groupBy(llave(F.col("_f")).alias("_k")).agg(F.max_by("_f", "_o").alias("_nueva"))
              .withColumn("_c", cubeta(F.col("_nueva"))))

    def juntas(solo: list[int]) -> DataFrame:
        """Stored rows of some buckets beside the new rows."""
        antes = _leer(spark, ruta, v, solo)
        antes = antes.select(fila(antes).alias("_vieja"))
        antes = antes.select(llave(F.col("_vieja")).alias("_l"), "_vieja", cubeta(F.col("_vieja")).alias("_d"))
        n = nuevas.filter(F.col("_c").isin(solo))
        return antes.join(n, (antes["_d"] == n["_c"]) & antes["_l"].eqNullSafe(n["_k"]), "full")

    # at most one number a bucket comes back
    tocadas = sorted(r["_c"] for r in nuevas.select("_c").distinct().collect())
    distinta = F.col("_vieja").isNull() if solo_crear else ~F.col("_vieja").eqNullSafe(F.col("_nueva"))
    cambian = sorted(r["_c"] for r in juntas(tocadas).filter(F.col("_nueva").isNotNull() & distinta)
                     .select("_c").distinct().collect()) if tocadas else []
    if not cambian and v["numero"]:
        return v["numero"]
    numero = v["numero"] + 1
    carpeta = f"{numero:010d}_{uuid.uuid4().hex}"
    if cambian:
        queda = F.coalesce("_vieja", "_nueva") if solo_crear else F.coalesce("_nueva", "_vieja")
        (juntas(cambian).select(F.coalesce("_c", "_d").alias("_c"), queda.alias("_f")).repartition(len(cambian), "_c")
         .select("_c", "_f.*").write.partitionBy("_c").parquet(f"{ruta}/datos/{carpeta}"))
    _publicar(spark, ruta, {**v, "numero": numero, "cubetas": {**v["cubetas"], **{str(c): carpeta for c in cambian}}})
    return numero


def fusionar_grafo(nodos: Mapping[str, DataFrame], aristas: Mapping[str, DataFrame], ruta: str, clave_nodo: str = "id",
                   clave_arista: tuple[str, ...] = ("src", "dst"), solo_crear: bool = False) -> None:
    """Merges node labels and edge types into the graph of ``ruta``: a node by its id, an edge by its ends."""
    for tipo, tablas, claves in (("nodos", nodos, [clave_nodo]), ("aristas", aristas, list(clave_arista))):
        for nombre, df in tablas.items():
            fusionar(df, f"{ruta}/{tipo}/{nombre}", claves, solo_crear=solo_crear)


def limpiar(spark: SparkSession, ruta: str) -> None:
    """Removes bucket files and versions that the latest version does not name.  No load or reader of an older version
    may run meanwhile."""
    v = version(spark, ruta)
    if v is None:
        return
    fs, datos = _fs(spark, f"{ruta}/datos")
    for f in fs.listStatus(datos) if fs.exists(datos) else []:
        carpeta = f.getPath().getName()
        for c in fs.listStatus(f.getPath()):
            if not any(carpeta == u and c.getPath().getName() == f"_c={k}" for k, u in v["cubetas"].items()):
                fs.delete(c.getPath(), True)
    _, versiones = _fs(spark, f"{ruta}/versiones")
    for f in fs.listStatus(versiones):
        if f.getPath().getName() != f"{v['numero']:010d}.json":
            fs.delete(f.getPath(), False)
