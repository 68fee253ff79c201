"""Column expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Status recode of the order feed, with its default.
ESTADOS_PEDIDO = {
    "PENDING": "pendiente",
    "READY": "pendiente",
    "PICKED_UP": "en_ruta",
    "CANCELLED": "cancelado",
}
ESTADO_POR_DEFECTO = "pendiente"

# Age bands, upper bound (exclusive) and label; the rest is "55+".
GRUPOS_EDAD = [(25, "18-24"), (35, "25-34"), (45, "35-44"), (55, "45-54")]
GRUPO_RESTO = "55+"


def dinero(c: Column | str) -> Column:
    """Exact sum of a money column, so the result does not depend on partition order."""
    return F.sum(_decimal(c))


def _decimal(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("decimal(18,2)")


def doble(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("double")


def cociente(a: Column, b: Column) -> Column:
    """a / b as double, NULL when b is 0 or NULL."""
    return F.try_divide(a.cast("double"), b.cast("double"))


def porcentaje(parte: Column, total: Column) -> Column:
    """100 * parte / total with two decimals."""
    return F.round(F.try_divide(parte * F.lit(100.0), total.cast("double")), 2)


def crecimiento(actual: Column, previo: Column) -> Column:
    """Percent growth with two decimals, NULL without a non-zero previous value."""
    return F.round(F.try_divide(F.lit(100.0) * (actual - previo), previo), 2)


def clave_tiempo(ts: Column) -> Column:
    """Surrogate time key at the grain of the timestamp: micros since the epoch."""
    return F.unix_micros(ts.cast("timestamp"))


def instante(clave: Column) -> Column:
    """The timestamp a time key stands for."""
    return F.timestamp_micros(clave)


def marca_tiempo(fecha: Column, hora: Column) -> Column:
    """Timestamp from a date column and an hour column; dirty rows give NULL."""
    return F.try_to_timestamp(F.concat_ws(" ", fecha, hora))


def grupo_edad(edad: Column) -> Column:
    (tope, nombre), *resto = GRUPOS_EDAD
    c = F.when(edad < tope, nombre)
    for tope, nombre in resto:
        c = c.when(edad < tope, nombre)
    return c.otherwise(GRUPO_RESTO)


def recodificar_estado(estado: Column) -> Column:
    tabla = F.create_map(*[F.lit(x) for par in ESTADOS_PEDIDO.items() for x in par])
    return F.coalesce(F.try_element_at(tabla, estado), F.lit(ESTADO_POR_DEFECTO))


def nombre_de_email(email: Column) -> Column:
    return F.split_part(email, F.lit("@"), F.lit(1))


def no_vacio(c: Column) -> Column:
    return c.isNotNull() & (c != "")


def redondeo_dinero(c: Column) -> Column:
    """Two decimals, half up."""
    return c.cast("decimal(10,2)").cast("double")
