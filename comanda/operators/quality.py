"""Data-quality checks as report rows (control, tabla, columna, observado, limite, correcto)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Bounds of the warehouse checks.
MINIMOS = {"dim_usuario": 10, "dim_restaurante": 5, "dim_menu": 20, "hechos_reservas": 50}
REQUERIDAS = {
    "hechos_reservas": ["tiempo_id", "usuario_id", "restaurante_id", "total"],
    "dim_tiempo": ["tiempo_id", "fecha", "ano", "mes", "dia"],
}
RANGOS = {"total": (0, 10000), "invitados": (1, 50)}


def _fila(control: str, tabla: str, columna: str, observado: Column, limite: str, correcto: Column) -> Column:
    return F.struct(F.lit(control).alias("control"), F.lit(tabla).alias("tabla"), F.lit(columna).alias("columna"),
                    observado.cast("bigint").alias("observado"), F.lit(limite).alias("limite"),
                    correcto.alias("correcto"))


def _filas(df: DataFrame, filas: list[Column]) -> DataFrame:
    return df.select(F.inline(F.array(*filas)))


def _unir(partes: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, partes)


def no_vacias(**tablas: DataFrame) -> DataFrame:
    return _unir([_filas(df.agg(F.count("*").alias("n")),
                         [_fila("no_vacia", t, "", F.col("n"), ">= 1", F.col("n") >= 1)])
                  for t, df in tablas.items()])


def huerfanos(pedidos: DataFrame, reservas: DataFrame) -> DataFrame:
    """Orders that no reservation refers to."""
    r = reservas.select(F.col("pedido_id").alias("id")).filter("id IS NOT NULL").distinct()
    n = pedidos.select("id").join(r, "id", "left_anti").agg(F.count("*").alias("n"))
    return _filas(n, [_fila("huerfanos", "pedidos", "id", F.col("n"), "= 0", F.col("n") == 0)])


def control_tabla(nombre: str, df: DataFrame, minimo: int | None = None,
                  requeridas: list[str] | None = None,
                  rangos: dict[str, tuple[float, float]] | None = None) -> DataFrame:
    """All checks of one table in a single pass over it."""
    rangos = {c: r for c, r in (rangos or {}).items() if c in df.columns}
    uno = df.agg(F.count("*").alias("n"),
                 *[F.count_if(~F.col(c).between(a, b)).alias(f"fuera_{c}") for c, (a, b) in rangos.items()])
    filas = []
    if minimo is not None:
        filas.append(_fila("minimo", nombre, "", F.col("n"), f">= {minimo}", F.col("n") >= minimo))
    for c in requeridas or []:
        filas.append(_fila("requerida", nombre, c, F.lit(int(c in df.columns)), "= 1", F.lit(c in df.columns)))
    for c, (a, b) in rangos.items():
        fuera = F.col(f"fuera_{c}")
        filas.append(_fila("rango", nombre, c, fuera, f"{a}..{b}", fuera == 0))
    return _filas(uno, filas)


def informe(dimensiones: dict[str, DataFrame], fuentes: dict[str, DataFrame]) -> DataFrame:
    """The whole report: source tables not empty, orphans, and the warehouse checks."""
    partes = [no_vacias(**fuentes), huerfanos(fuentes["pedidos"], fuentes["reservas"])]
    for t, df in dimensiones.items():
        if t in MINIMOS or t in REQUERIDAS:
            rangos = RANGOS if t == "hechos_reservas" else None
            partes.append(control_tabla(t, df, MINIMOS.get(t), REQUERIDAS.get(t), rangos))
    return _unir(partes)


def exigir(reporte: DataFrame, controles: tuple[str, ...] = ("no_vacia",)) -> None:
    """Raises when one of the named checks failed; other failures are warnings of the report."""
    malos = reporte.filter(F.col("control").isin(*controles) & ~F.col("correcto")).collect()
    if malos:
        raise ValueError("failed checks: " + ", ".join(f"{r.control} {r.tabla} {r.columna}".strip() for r in malos))
