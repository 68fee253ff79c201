"""Distances and travel times as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
RADIO_TIERRA_M = 6_371_000.0
METROS_POR_GRADO = 111_000.0
VELOCIDAD_KMH = 25.0


def haversine_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle metres."""
    sen_lat = F.sin(F.radians(lat2 - lat1) / 2)
    sen_lon = F.sin(F.radians(lon2 - lon1) / 2)
    h = sen_lat * sen_lat + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * sen_lon * sen_lon
    return F.lit(2 * RADIO_TIERRA_M) * F.atan2(F.sqrt(h), F.sqrt(F.lit(1.0) - h))


def plana_grados(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    dlat, dlon = lat1 - lat2, lon1 - lon2
    return F.sqrt(dlat * dlat + dlon * dlon)


def plana_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Planar metres from degrees."""
    return plana_grados(lat1, lon1, lat2, lon2) * METROS_POR_GRADO


def manhattan_grados(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    return F.abs(lat1 - lat2) + F.abs(lon1 - lon2)


def minutos_viaje(metros: Column, kmh: Column | float = VELOCIDAD_KMH) -> Column:
    """Whole minutes, at least 1 for a positive distance, 0 otherwise."""
    v = kmh if isinstance(kmh, Column) else F.lit(float(kmh))
    enteros = F.floor(metros / 1000 / v * 60).cast("int")
    return F.when(metros <= 0, F.lit(0)).otherwise(F.greatest(F.lit(1), enteros))


def costo_repartidor(metros: Column, kmh: Column, carga: Column) -> Column:
    """Travel minutes plus ten per order already carried."""
    return minutos_viaje(metros, kmh) + carga * 10
