"""Star schema: four dimensions and the reservation fact."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from comanda.functions.expr import clave_tiempo, instante, marca_tiempo

# Source column -> dimension column, per source table.
MAPEOS = {
    "usuarios": {"id": "usuario_id", "email": "email", "rol": "rol", "fecha_alta": "fecha_alta"},
    "restaurantes": {"id": "restaurante_id", "nombre": "nombre", "categoria_local": "categoria",
                     "capacidad": "capacidad", "lat": "lat", "lon": "lon"},
    "menus": {"id": "menu_id", "titulo": "titulo_menu", "categoria": "categoria_menu",
              "activo": "activo", "restaurante_id": "restaurante_id"},
    "reservas": {"id": "reserva_id", "usuario_id": "usuario_id", "restaurante_id": "restaurante_id",
                 "fecha": "fecha_reserva", "estado": "estado_reserva", "invitados": "invitados"},
    "pedidos": {"id": "pedido_id", "menu_id": "menu_id", "total": "total", "estado": "estado_pedido",
                "restaurante_id": "restaurante_id", "usuario_id": "usuario_id"},
}

_SALES = 1024


def mapear(df: DataFrame, mapeo: dict[str, str]) -> DataFrame:
    """Projection that renames source columns; columns the source lacks are skipped."""
    return df.select([F.col(s).alias(t) for s, t in mapeo.items() if s in df.columns])


def dim_usuario(usuarios: DataFrame) -> DataFrame:
    return mapear(usuarios, MAPEOS["usuarios"])


def dim_restaurante(restaurantes: DataFrame) -> DataFrame:
    return mapear(restaurantes, MAPEOS["restaurantes"])


def dim_menu(menus: DataFrame) -> DataFrame:
    return mapear(menus, MAPEOS["menus"])


def partes_tiempo(ts: Column) -> dict[str, Column]:
    return {
        "fecha": F.to_date(ts),
        "ano": F.year(ts),
        "mes": F.month(ts),
        "dia": F.dayofmonth(ts),
        "hora": F.hour(ts),
        "nombre_mes_completo": F.date_format(ts, "MMMM"),
        "dia_semana": F.date_format(ts, "EEEE"),
    }


def con_marca(reservas: DataFrame) -> DataFrame:
    """Adds ``timestamp_reserva`` from ``fecha`` and ``hora`` where the source has no timestamp."""
    if "timestamp_reserva" in reservas.columns:
        return reservas
    return reservas.withColumn("timestamp_reserva", marca_tiempo(F.col("fecha"), F.col("hora")))


def dim_tiempo(reservas: DataFrame) -> DataFrame:
    """One row per distinct reservation timestamp."""
    ts = F.col("fecha_reserva")
    return (
        con_marca(reservas)
        .select(F.col("timestamp_reserva").alias("fecha_reserva"))
        .filter(ts.isNotNull())
        .distinct()
        .select(clave_tiempo(ts).alias("tiempo_id"), ts,
                *[c.alias(n) for n, c in partes_tiempo(ts).items()])
    )


def _reservas_con_pedido(reservas: DataFrame, pedidos: DataFrame) -> DataFrame:
    """Left join on the order id.  Rows without an order id would all hash to one partition,
    so they get a spread second key; they match nothing either way."""
    r = con_marca(reservas).withColumn(
        "_sal", F.when(F.col("pedido_id").isNull(), F.pmod(F.xxhash64("id"), F.lit(_SALES))).otherwise(F.lit(0)))
    p = pedidos.select(F.col("id").alias("_pid"), F.lit(0).cast("bigint").alias("_psal"),
                       "total", F.col("estado").alias("estado_pedido"))
    return r.join(p, (F.col("pedido_id") == F.col("_pid")) & (F.col("_sal") == F.col("_psal")), "left")


def hechos_reservas(reservas: DataFrame, pedidos: DataFrame) -> DataFrame:
    """Fact: every reservation with a timestamp, with the amount and status of its order.

    The time key is computed from the timestamp, which gives the same rows as joining the
    time dimension on it, without shuffling the fact for a dimension of nearly its size.
    """
    con_ts = con_marca(reservas).filter(F.col("timestamp_reserva").isNotNull())
    return _reservas_con_pedido(con_ts, pedidos).select(
        clave_tiempo(F.col("timestamp_reserva")).alias("tiempo_id"),
        "usuario_id", *[c for c in ("restaurante_id", "menu_id") if c in reservas.columns], "total",
        F.col("estado").alias("estado_reserva"), "estado_pedido", "invitados")


def con_tiempo(hechos: DataFrame, columnas: list[str], dim: DataFrame | None = None) -> DataFrame:
    """Fact with time attributes: derived from the key, or joined when ``dim`` has other keys."""
    if dim is not None:
        return hechos.join(dim.select("tiempo_id", *columnas), "tiempo_id")
    partes = partes_tiempo(instante(F.col("tiempo_id")))
    return hechos.select("*", *[partes[c].alias(c) for c in columnas])


def reservas_completas(reservas: DataFrame, pedidos: DataFrame, desde: Column | None = None) -> DataFrame:
    """Extract with defaults for reservations without an order; ``desde`` keeps recent rows."""
    ts = F.col("timestamp_reserva")
    r = con_marca(reservas)
    if desde is not None:
        r = r.filter(F.to_date(ts) >= desde)
    return _reservas_con_pedido(r, pedidos).select(
        F.col("id").alias("reserva_id"), "usuario_id", "restaurante_id", ts.alias("fecha_reserva"),
        F.col("estado").alias("estado_reserva"), "invitados",
        F.coalesce("total", F.lit(0.0)).alias("total"),
        F.coalesce("estado_pedido", F.lit("sin_pedido")).alias("estado_pedido"), "menu_id")


def menus_activos(menus: DataFrame, restaurantes: DataFrame) -> DataFrame:
    r = restaurantes.select(F.col("id").alias("restaurante_id"), F.col("nombre").alias("restaurante_nombre"))
    return menus.filter("activo").join(r, "restaurante_id").select(
        "id", "titulo", "categoria", "activo", "restaurante_id", "restaurante_nombre")
