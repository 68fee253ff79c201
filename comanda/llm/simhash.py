"""SimHash near-duplicates: fingerprints, deletion-variant signatures, components."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from comanda.llm.comun import ES_NO_BLANCO, Palabras, como_fila, por_pasos, textos, unir_repartido
from comanda.operators.rank import componentes
from comanda.plans.durable import Corte

SEMILLA = 42


def huellas_simhash(t: pa.Array, k: int = 3) -> np.ndarray:
    """Fingerprint of each text as unsigned 64-bit numbers."""
    p = Palabras(t, ES_NO_BLANCO)
    seguidas, ini, fin = p.seguidas()
    n = np.maximum(p.n - k + 1, np.minimum(p.n, 1))  # shingles of each text
    total = int(n.sum())
    doc = np.repeat(np.arange(len(n)), n)
    desde = np.arange(total) - np.repeat(np.cumsum(n) - n, n) + p.primera[doc]
    hasta = desde + np.minimum(p.n[doc], k) - 1
    h = xxhash.xxh64_intdigest
    valores = np.fromiter((h(seguidas[a:b], SEMILLA) for a, b in zip(ini[desde].tolist(), fin[hasta].tolist())),
                          np.uint64, total)
    salida = np.zeros(len(n), np.uint64)
    con = np.flatnonzero(n)
    # bounded slices of whole texts: 64 counters a shingle
    paso = 1 << 17
    cabeza = np.cumsum(n) - n
    cuenta = np.zeros((len(n), 64), np.int64)
    for a in range(0, total, paso):
        b = min(total, a + paso)
        bits = np.unpackbits(valores[a:b].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        d0, d1 = doc[a], doc[b - 1]
        dentro = con[np.searchsorted(con, d0): np.searchsorted(con, d1, "right")]
        cortes = np.maximum(cabeza[dentro] - a, 0)
        cuenta[dentro] += np.add.reduceat(bits, cortes, axis=0, dtype=np.int64)
    mayoria = 2 * cuenta > n[:, None]
    salida[con] = np.packbits(mayoria[con], axis=1).view(">u8").reshape(-1).astype(np.uint64)
    return salida


def huellas(docs: DataFrame, id_doc: str = "doc_id", texto: str = "text", k: int = 3,
            conservar: list[str] | None = None) -> DataFrame:
    """(id, huella): one row per input row, the 64-bit fingerprint as a signed number; then ``conservar``."""
    mas = conservar or []
    tipo = StructType([StructField("id", docs.schema[id_doc].dataType), StructField("huella", LongType()),
                       *[docs.schema[c] for c in mas]])

    def paso(lote: pa.RecordBatch) -> pa.RecordBatch:
        fila = lote.column(0)
        return pa.RecordBatch.from_arrays(
            [fila.field(0), pa.array(huellas_simhash(textos(lote, 1), k).view(np.int64)),
             *[fila.field(2 + n) for n in range(len(mas))]], ["id", "huella", *mas])

    return como_fila(docs.select(id_doc, texto, *mas)).mapInArrow(por_pasos(paso, 1), tipo)


def _variantes(df: DataFrame, ancho: int) -> DataFrame:
    """Signatures of the ``ancho`` bits that start at ``resto``: either half, with one bit deleted.

    Of two halves that differ in three bits at most, one differs in one at most, so it is equal in
    the variant without that bit.  ``resto`` of a signature is where the other half starts.
    """
    m = ancho // 2
    return df.select("huella", F.expr(f"""inline(flatten(transform(array(0, {m}), mitad -> transform(
        sequence(0, {m - 1}), bit -> named_struct(
            'clave', xxhash64(clave, mitad, bit, shiftrightunsigned(huella, resto + mitad) & {(1 << m) - 1}L
                              & ~shiftleft(1L, bit)),
            'resto', resto + {m} - mitad)))))"""))


def enlaces(unicas: DataFrame, corte: Corte, distancia: int = 3, tope: int = 64) -> DataFrame:
    """(src, dst): pairs of the distinct fingerprints ``unicas(huella)`` that differ in ``distancia`` bits or fewer.

    Signatures are shuffled once and counted where they arrive, and those of a single fingerprint are
    dropped.  The rows are distinct fingerprints, so copies never add to a signature.  A signature of more than
    ``tope`` fingerprints is cut again, by its other half, and again by half of that; after three cuts
    its fingerprints agree in all but 11 bits, so the largest possible one has 2048.  No pair is lost:
    every cut keeps each pair within three bits together in some signature.
    """
    if not 0 <= distancia <= 3:
        raise ValueError("two halves with one deleted bit find pairs of up to three bits")
    nivel = unicas.select("huella", F.lit(0).cast("bigint").alias("clave"), F.lit(0).alias("resto"))
    salida = None
    for ancho in (64, 32, 16):
        var = _variantes(nivel, ancho).withColumn("n", F.count("*").over(Window.partitionBy("clave")))
        juntas, n = corte.guardar(var.filter("n > 1"))
        if not n:
            break
        hondo = ancho == 16
        cerca = juntas if hondo else juntas.filter(F.col("n") <= tope)
        a, b = cerca.select("clave", F.col("huella").alias("src")), cerca.select("clave", F.col("huella").alias("dst"))
        pares = a.join(b, "clave").filter((F.col("src") < F.col("dst"))
                                          & (F.bit_count(F.col("src").bitwiseXOR(F.col("dst"))) <= distancia))
        pares = pares.select("src", "dst")
        salida = pares if salida is None else salida.unionByName(pares)
        nivel = juntas.filter(F.col("n") > tope).select("huella", "clave", "resto")
    vacio = unicas.select(F.col("huella").alias("src"), F.col("huella").alias("dst")).limit(0)
    return vacio if salida is None else salida.distinct()


def grupos(docs: DataFrame, id_doc: str = "doc_id", texto: str = "text", k: int = 3, distancia: int = 3) -> DataFrame:
    """(id, huella, grupo): one row per input row; ``grupo`` is the smallest id reachable over links.

    Texts without a word have fingerprint 0 and link like any other; null text counts as empty.  A
    null id is never a ``grupo`` unless its whole component has none.  Repeated rows are rows of their
    own.  Copies are one fingerprint from the first aggregate on, so a group of copies costs one row.
    """
    corte = Corte(docs.sparkSession, "simhash")
    h, total = corte.guardar(huellas(docs, id_doc, texto, k))
    u, _ = corte.guardar(h.groupBy("huella").agg(F.min("id").alias("menor"), F.count("*").alias("n")))
    return unir_repartido(h, _con_grupo(u, corte, distancia), "huella", "n", total).select("id", "huella", "grupo")


def _con_grupo(u: DataFrame, corte: Corte, distancia: int) -> DataFrame:
    """(huella, grupo, n) of the distinct ``u(huella, menor, n)``: the smallest ``menor`` reachable over links."""
    e, n = corte.guardar(enlaces(u, corte, distancia))
    con_grupo = u.withColumnRenamed("menor", "grupo")
    if n:
        nodos = e.select(F.explode(F.array("src", "dst")).alias("id")).distinct()
        comp = componentes(nodos, e).withColumnRenamed("id", "huella")
        de_comp, _ = corte.guardar(comp.join(u, "huella"))
        menores = de_comp.groupBy("comunidad").agg(F.min("menor").alias("grupo"))
        de_comp = de_comp.join(menores, "comunidad").select("huella", "grupo", "n")
        con_grupo, _ = corte.guardar(
            de_comp.unionByName(con_grupo.join(de_comp.select("huella"), "huella", "left_anti")))
    return con_grupo


def uno_por_grupo(docs: DataFrame, id_doc: str = "doc_id", texto: str = "text", k: int = 3,
                  distancia: int = 3) -> DataFrame:
    """One row of ``docs``, all columns, of each group: that of the smallest id, null last, then of the smallest
    fingerprint, then of the smallest hash of the whole row.

    Decided by row, not by id: rows of one id with different texts are in groups of their own, and a row without
    an id stays where it leads its group.
    """
    corte = Corte(docs.sparkSession, "simhash_filtro")
    filas = como_fila(docs).withColumn("_id", F.col("fila").getField(id_doc)).withColumn("_marca", F.xxhash64("fila"))
    h, _ = corte.guardar(huellas(filas.select("_id", "_marca", F.col("fila").getField(texto).alias("_texto")),
                                 "_id", "_texto", k, ["_marca"])
                         .groupBy("id", "huella", "_marca").agg(F.count("*").alias("_n")))
    lider = F.struct(F.col("id").isNull().alias("sin"), "id", "huella", "_marca", "_n")
    u, _ = corte.guardar(h.groupBy("huella").agg(F.min(lider).alias("menor"), F.sum("_n").alias("n")))
    quedan, _ = corte.guardar(_con_grupo(u, corte, distancia).select("grupo").distinct().select(
        F.col("grupo.id").alias("_i"), F.col("grupo._marca").alias("_m"), F.col("grupo._n").alias("_n")))
    este = F.col("_id").eqNullSafe(F.col("_i")) & (F.col("_marca") == F.col("_m"))
    una_vez = filas.join(quedan.filter("_n = 1"), este, "left_semi")
    repetidas = filas.join(quedan.filter("_n > 1"), este, "left_semi").dropDuplicates(["_id", "_marca"])
    return una_vez.unionByName(repetidas).select("fila.*")
