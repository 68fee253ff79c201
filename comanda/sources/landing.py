"""Readers of the landing files, the order database and the road map."""

from __future__ import annotations

from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Declared columns of the landing files, cast once when they are read.
ESQUEMAS = {
    "usuarios": "id BIGINT, email STRING, rol STRING, fecha_alta TIMESTAMP",
    "restaurantes": "id BIGINT, nombre STRING, direccion STRING, telefono STRING, capacidad INT, "
                    "categoria_local STRING, lat DOUBLE, lon DOUBLE",
    "menus": "id BIGINT, titulo STRING, categoria STRING, activo BOOLEAN, restaurante_id BIGINT",
    "productos": "id BIGINT, restaurante_id BIGINT, nombre STRING, descripcion STRING, precio DOUBLE, "
                 "categoria STRING, disponible BOOLEAN, tiempo_preparacion INT, calorias INT, "
                 "vegetariano BOOLEAN, picante BOOLEAN",
    "pedidos": "id BIGINT, menu_id BIGINT, total DOUBLE, estado STRING, restaurante_id BIGINT, "
               "usuario_id BIGINT, fecha_creacion TIMESTAMP",
    "reservas": "id BIGINT, usuario_id BIGINT, restaurante_id BIGINT, menu_id BIGINT, pedido_id BIGINT, "
                "fecha STRING, hora STRING, estado STRING, invitados INT",
    "pedido_detalle": "pedido_id BIGINT, producto_id BIGINT, cantidad INT, precio_unitario DOUBLE",
    "nombres_calle": "node_id STRING, street_name STRING",
}
CORRUPTA = "_corrupt_record"
_SOBRA, _LINEA = "_sobra", "_linea"

_NODO = "_id STRING, _lat DOUBLE, _lon DOUBLE"
_VIA = "_id STRING, nd ARRAY<STRUCT<_ref: STRING>>, tag ARRAY<STRUCT<_k: STRING, _v: STRING>>"


def esquema(entidad: str) -> T.StructType:
    return T.StructType.fromDDL(ESQUEMAS[entidad])


def indice_de_cabeceras(spark: SparkSession, ruta: str) -> list[list[str]]:
    """The files of a folder (or the one file) in groups of equal first lines; empty files are in none.

    First lines are read as a table, one row a file, in one text scan.  The driver gets the file names, which Spark's own
    file listing holds there as well.  The line only tells the groups apart: how it is split is left to the CSV reader.
    """
    lineas = spark.read.text(ruta).select(
        F.col("_metadata.file_path").alias("ruta"), F.col("_metadata.file_block_start").alias("desde"), "value",
        F.monotonically_increasing_id().alias("n")).filter("desde = 0")
    primeras_lineas = lineas.groupBy("ruta").agg(F.min_by("value", "n").alias("cabecera"))
    grupos = primeras_lineas.groupBy("cabecera").agg(F.sort_array(F.collect_list("ruta")).alias("rutas"))
    return sorted([unquote(x) for x in g["rutas"]] for g in grupos.collect())


def leer_csv(spark: SparkSession, ruta: str, entidad: str, opcional: bool = False, con_corruptas: bool = False) -> DataFrame:
    """Typed frame of header CSVs, columns matched by name; 't'/'f' are read as booleans.

    The files of a folder may have their columns in any order and number: files of equal header are one scan.  A column
    that a file lacks is NULL, others that it has are left out.  A value that does not fit its column becomes NULL;
    ``con_corruptas`` also keeps the raw line of such rows.  Files without a line give no rows.  ``opcional`` gives an
    empty typed frame when the path does not exist.
    """
    tipos = esquema(entidad)
    vacia = T.StructType([*tipos, *([T.StructField(CORRUPTA, T.StringType())] if con_corruptas else [])])
    if opcional and not _existe(spark, ruta):
        return spark.createDataFrame([], vacia)
    grupos = indice_de_cabeceras(spark, ruta)
    partes = [_de_un_orden(spark, ruta if len(grupos) == 1 else g, tipos, con_corruptas) for g in grupos]
    if not partes:
        return spark.createDataFrame([], vacia)
    return reduce(DataFrame.unionByName, partes)


def _de_un_orden(spark: SparkSession, rutas: str | list[str], tipos: T.StructType, con_corruptas: bool) -> DataFrame:
    lector = lambda: spark.read.option("header", True).option("escape", '"').option("multiLine", True)
    crudo = lector().option("enforceSchema", False).csv(rutas)
    nombres = crudo.columns
    if con_corruptas:
        # with a column more than the file has, every row is one that the reader keeps the raw text of
        texto = T.StructType([T.StructField(c, T.StringType()) for c in [*nombres, _SOBRA, _LINEA]])
        crudo = lector().schema(texto).option("columnNameOfCorruptRecord", _LINEA).csv(rutas)
    columnas = [(F.col(f"`{c.name}`") if c.name in nombres else F.lit(None).cast("string")).try_cast(c.dataType).alias(c.name)
                for c in tipos]
    if con_corruptas:
        mal = [F.col(f"`{c.name}`").isNotNull() & F.col(f"`{c.name}`").try_cast(c.dataType).isNull()
               for c in tipos if c.name in nombres]
        # a row with just that one value too many has no raw text; it is written anew
        linea = F.coalesce(_LINEA, F.to_csv(F.struct(*[f"`{c}`" for c in nombres], _SOBRA)))
        columnas.append(F.when(reduce(Column.__or__, mal, F.lit(False)), linea).alias(CORRUPTA))
    return crudo.select(columnas)


def _existe(spark: SparkSession, ruta: str) -> bool:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(ruta)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop)


def primeras(df: DataFrame, n: int, orden: str = "id") -> DataFrame:
    """Row-capped read: the first ``n`` rows in id order, taken before any filter."""
    return df.orderBy(orden).limit(n)


def clientes(usuarios: DataFrame, max_usuarios: int | None = None) -> DataFrame:
    """Users with the customer role; a cap counts rows before the role filter."""
    u = usuarios if max_usuarios is None else primeras(usuarios, max_usuarios)
    return u.filter("rol = 'Cliente'").withColumn("nombre", F.split_part("email", F.lit("@"), F.lit(1)))


def pedidos_activos(pedidos: DataFrame, usuarios: DataFrame, restaurantes: DataFrame,
                    max_pedidos: int | None = None) -> DataFrame:
    """Open orders of loaded users and restaurants; a cap counts rows before the filters."""
    p = pedidos if max_pedidos is None else primeras(pedidos, max_pedidos)
    return (p.filter(F.col("estado").isin("PENDING", "READY"))
            .join(usuarios.select(F.col("id").alias("usuario_id")), "usuario_id", "left_semi")
            .join(restaurantes.select(F.col("id").alias("restaurante_id")), "restaurante_id", "left_semi")
            .withColumn("items", F.array(F.format_string("Item_%d", "menu_id"))))


def leer_jdbc(spark: SparkSession, tabla: str, opciones: dict[str, str], clave: str = "id",
              desde: int | None = None, hasta: int | None = None, particiones: int = 64) -> DataFrame:
    """Full extract of one table over JDBC, split by ranges of ``clave`` when its bounds are given.
    The address and the credentials come in ``opciones`` only."""
    r = spark.read.format("jdbc").options(**opciones).option("dbtable", tabla)
    if desde is not None and hasta is not None:
        r = (r.option("partitionColumn", clave).option("lowerBound", str(desde)).option("upperBound", str(hasta))
             .option("numPartitions", str(particiones)))
    return r.load()


def leer_nodos_osm(spark: SparkSession, ruta: str) -> DataFrame:
    """Road-map nodes (id, lat, lon)."""
    x = spark.read.format("xml").option("rowTag", "node").schema(_NODO).load(ruta)
    return x.select(F.col("_id").alias("id"), F.col("_lat").alias("lat"), F.col("_lon").alias("lon"))


def leer_vias_osm(spark: SparkSession, ruta: str) -> DataFrame:
    """Road-map ways (id, nd: node ids in order, nombre)."""
    x = spark.read.format("xml").option("rowTag", "way").schema(_VIA).load(ruta)
    nombre = F.get(F.filter("tag", lambda t: t["_k"] == "name"), F.lit(0))["_v"]
    return x.select(F.col("_id").alias("id"), F.col("nd._ref").alias("nd"), nombre.alias("nombre"))


def catalogo_reciente(menus: DataFrame, ahora, horas: int = 24) -> DataFrame:
    """Catalogue rows changed in the last hours, where the source keeps ``updated_at``."""
    if "updated_at" not in menus.columns:
        return menus
    return menus.filter(F.col("updated_at") >= F.lit(ahora) - F.make_dt_interval(hours=F.lit(horas)))


