"""Table, view, file and document sinks."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Declared tables of the warehouse.
TABLAS = {
    "dim_tiempo": "tiempo_id BIGINT, fecha_reserva TIMESTAMP, fecha DATE, ano INT, mes INT, dia INT, hora INT, "
                  "nombre_mes_completo STRING, dia_semana STRING",
    "dim_usuario": "usuario_id BIGINT, email STRING, rol STRING, fecha_alta TIMESTAMP",
    "dim_restaurante": "restaurante_id BIGINT, nombre STRING, categoria STRING, capacidad INT, lat DOUBLE, lon DOUBLE",
    "dim_menu": "menu_id BIGINT, titulo_menu STRING, categoria_menu STRING, activo BOOLEAN, restaurante_id BIGINT",
    "hechos_reservas": "tiempo_id BIGINT, usuario_id BIGINT, restaurante_id BIGINT, menu_id BIGINT, total DOUBLE, "
                       "estado_reserva STRING, estado_pedido STRING, invitados INT",
}
BASE = "restaurantes_dw"


def crear_base(spark: SparkSession, base: str = BASE, ubicacion: str | None = None) -> None:
    donde = f" LOCATION '{ubicacion}'" if ubicacion else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {base}{donde}")


def crear_tablas(spark: SparkSession, base: str = BASE) -> None:
    """Declared tables that do not exist yet."""
    for nombre, columnas in TABLAS.items():
        spark.sql(f"CREATE TABLE IF NOT EXISTS {base}.{nombre} ({columnas}) USING parquet")


def reemplazar_tabla(df: DataFrame, nombre: str, base: str = BASE, particion: list[str] | None = None) -> None:
    """Writes the table anew in place of what it held."""
    w = df.write.mode("overwrite").format("parquet")
    if particion:
        w = w.partitionBy(*particion)
    w.saveAsTable(f"{base}.{nombre}")


def crear_vistas(vistas: Mapping[str, Callable[[], DataFrame]]) -> None:
    """Session views, each defined by the function that builds its frame."""
    for nombre, f in vistas.items():
        f().createOrReplaceTempView(nombre)


def documentos_busqueda(menus: DataFrame, ahora: Column) -> DataFrame:
    """Search documents (_id, doc) of the product catalogue, the last row of an id winning
    when the source has ``updated_at``."""
    campos = ["id", "titulo", "categoria", "activo", "restaurante_id"]
    fila = F.struct(*campos)
    orden = F.struct("updated_at", fila) if "updated_at" in menus.columns else fila
    return (menus.groupBy(F.col("id").alias("_id")).agg(F.max_by(fila, orden).alias("d"))
            .select("_id", F.to_json(F.struct("d.*", ahora.alias("updated_at"))).alias("doc")))


def escribir_documentos(documentos: DataFrame, ruta: str) -> None:
    documentos.write.mode("overwrite").json(ruta)


def escribir_csv(df: DataFrame, ruta: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(ruta)


def escribir_grafo(nodos: Mapping[str, DataFrame], aristas: Mapping[str, DataFrame], ruta: str) -> None:
    """Whole graph written anew: one folder per node label and per edge type."""
    for tipo, tablas in (("nodos", nodos), ("aristas", aristas)):
        for nombre, df in tablas.items():
            df.write.mode("overwrite").parquet(f"{ruta}/{tipo}/{nombre}")
