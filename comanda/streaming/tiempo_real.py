"""The two analyses that also make sense on a stream: peak hours and courier positions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RETRASO = "1 hour"


def reservas_por_hora(reservas: DataFrame, retraso: str = RETRASO) -> DataFrame:
    """Reservations per clock hour from a stream with ``timestamp_reserva`` (TIMESTAMP); an hour is
    final once the watermark has passed it."""
    return (reservas.withWatermark("timestamp_reserva", retraso)
            .groupBy(F.window("timestamp_reserva", "1 hour"))
            .agg(F.count("*").alias("reservas"))
            .select(F.col("window.start").alias("inicio"), F.hour("window.start").alias("hora"), "reservas"))


def horarios_pico(por_hora: DataFrame) -> DataFrame:
    """Peak hours from the finished hours a stream has written."""
    return (por_hora.groupBy("hora").agg(F.sum("reservas").alias("total_reservas"))
            .orderBy(F.desc("total_reservas"), "hora"))


def ultimas_posiciones(posiciones: DataFrame) -> DataFrame:
    """Latest position per courier from a stream (repartidor_id, lat, lon, ts, secuencia); the state
    is one row per courier."""
    return (posiciones.groupBy("repartidor_id")
            .agg(F.max_by(F.struct("lat", "lon"), F.struct("ts", "secuencia")).alias("p"))
            .select("repartidor_id", "p.lat", "p.lon"))
