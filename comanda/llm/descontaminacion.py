"""Benchmark decontamination: prefix-filtered join of documents with benchmark windows.

A window is ``VENTANA`` consecutive words of an item, or the whole item if it is shorter.  A document
holds a window if it holds all its shingles, so one necessary shingle finds every candidate: the prefix
of length one, with shingles ordered by how rare they are over the whole corpus.  The shingle's place in
the window gives the only place where the window can stand; length and position must leave room for it,
and the item-sized stretch of the document is then compared word by word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from comanda.llm.comun import ES_PALABRA, Palabras, como_fila, cortar, huellas_de_grupo, soltar, textos

VENTANA = 13
TEJA = 3
#: Words of benchmark text whose windows one pass over the documents carries; more are further passes.
PALABRAS_POR_BLOQUE = 500_000


class Bloque:
    """The windows of some items and, once ``ordenar`` knows the corpus counts, the index of their prefixes."""

    def __init__(self, items: list[tuple[str | None, str]], ventana: int = VENTANA):
        p = Palabras(pa.array([t for _, t in items], pa.string()), ES_PALABRA)
        seguidas, ini, fin = p.seguidas()
        h = p.huellas()
        por_texto: dict[bytes, int] = {}
        self.de_item: list[set] = []
        donde: list[int] = []
        largo: list[int] = []
        for i, (item, _) in enumerate(items):
            n, a = int(p.n[i]), int(p.primera[i])
            m = min(n, ventana)
            for s in range(a, a + n - m + 1) if n else ():
                texto = seguidas[ini[s]: fin[s + m - 1]]
                v = por_texto.setdefault(texto, len(por_texto))
                if v == len(self.de_item):
                    self.de_item.append(set())
                    donde.append(s)
                    largo.append(m)
                self.de_item[v].add(item)
        self.textos = list(por_texto)
        self.largo = np.array(largo, np.int64)
        # word hashes of each window, padded: a first test before the bytes are compared
        paso = np.arange(ventana)
        self.palabras = h[np.minimum(np.array(donde, np.int64)[:, None] + paso, max(0, len(h) - 1))] if donde else \
            np.zeros((0, ventana), np.uint64)
        self.ventana = ventana
        # shingles (size, hash) of each window; a window of fewer words than TEJA is one shingle
        self.tejas: dict[int, np.ndarray] = {}
        self._de: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for g in range(1, TEJA + 1):
            cuales = np.flatnonzero(np.minimum(self.largo, TEJA) == g)
            if len(cuales):
                cada = np.stack([huellas_de_grupo(f[:n], g)[np.minimum(np.arange(ventana - g + 1), n - g)]
                                 for f, n in zip(self.palabras[cuales], self.largo[cuales])])
                self._de[g] = (cuales, cada)
                self.tejas[g] = np.unique(cada)
        self.prefijos: dict[int, tuple[np.ndarray, ...]] = {}

    def ordenar(self, veces: dict[tuple[int, int], int]) -> None:
        """Chooses each window's rarest shingle; ``veces`` counts shingles (size, signed hash) in the corpus."""
        for g, (cuales, cada) in self._de.items():
            orden = np.array([veces.get((g, int(x)), 0) for x in self.tejas[g].view(np.int64)], np.int64)
            lugar = np.argmin(orden[np.searchsorted(self.tejas[g], cada)], axis=1)
            teja = cada[np.arange(len(cuales)), lugar]
            sube = np.argsort(teja, kind="stable")
            claves, desde, n = np.unique(teja[sube], return_index=True, return_counts=True)
            self.prefijos[g] = (claves, desde, n, cuales[sube], lugar[sube])

    def candidatos(self, p: Palabras, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(window, first word) of every place where a prefix shingle stands and the window has room."""
        v, s = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for g, (claves, desde, n, ventanas, lugares) in self.prefijos.items():
            t = huellas_de_grupo(h, g)
            k = np.minimum(np.searchsorted(claves, t), len(claves) - 1)
            en = np.flatnonzero(claves[k] == t)
            veces = n[k[en]]
            cada = np.repeat(desde[k[en]] - (np.cumsum(veces) - veces), veces) + np.arange(int(veces.sum()))
            v.append(ventanas[cada])
            s.append(np.repeat(en, veces) - lugares[cada])
        v, s = np.concatenate(v), np.concatenate(s)
        dentro = (s >= 0) & (s + self.largo[v] <= len(h))
        v, s = v[dentro], s[dentro]
        un_texto = p.doc[s] == p.doc[s + self.largo[v] - 1]
        return v[un_texto], s[un_texto]

    def lugares(self, p: Palabras, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(window, first word) of every occurrence of a window, compared byte by byte."""
        v, s = self.candidatos(p, h)
        if not len(v):
            return v, s
        igual = np.ones(len(v), bool)
        for k in range(self.ventana):
            en = k < self.largo[v]
            igual &= ~en | (h[np.minimum(s + k, len(h) - 1)] == self.palabras[v, k])
        v, s = v[igual], s[igual]
        seguidas, ini, fin = p.seguidas()
        a, b = ini[s].tolist(), fin[s + self.largo[v] - 1].tolist()
        exacto = np.fromiter((seguidas[x:y] == self.textos[w] for w, x, y in zip(v.tolist(), a, b)), bool, len(v))
        return v[exacto], s[exacto]


def _bloques(banco: DataFrame, item: str, texto: str, ventana: int, palabras: int) -> Iterator[Bloque]:
    """The benchmark in blocks of about ``palabras`` words, so what a task holds has a bound at any size.

    A window that stands in items of two blocks is found in both and its items are united.
    """
    limpio = banco.select(F.col(item).cast("string").alias("i"), F.col(texto).alias("t")).filter("t IS NOT NULL")
    # a word takes two bytes of text at least, with its separator
    total = limpio.agg(F.coalesce(F.sum((F.octet_length("t") + 1) / 2), F.lit(0)).cast("bigint")).first()[0]
    n = max(1, -(-total // palabras))
    for b in range(n):
        parte = limpio if n == 1 else limpio.filter(F.pmod(F.xxhash64("i", "t"), F.lit(n)) == b)
        yield Bloque([(r.i, r.t) for r in parte.distinct().toLocalIterator()], ventana)


def _contar_tejas(docs: DataFrame, texto: str, b: Bloque) -> dict[tuple[int, int], int]:
    """How often each shingle of the block stands in the whole corpus."""
    tejas = b.tejas

    def contar(lotes: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        soltar()
        suma = {g: np.zeros(len(t), np.int64) for g, t in tejas.items()}
        for lote in (c for x in lotes for c in cortar(x, 0)):
            p = Palabras(textos(lote, 0), ES_PALABRA)
            h = p.huellas()
            for g, t in tejas.items():
                x = huellas_de_grupo(h, g)
                k = np.minimum(np.searchsorted(t, x), len(t) - 1)
                suma[g] += np.bincount(k[t[k] == x], minlength=len(t))
        for g, t in tejas.items():
            con = np.flatnonzero(suma[g])
            yield pa.RecordBatch.from_pydict({"g": np.full(len(con), g, np.int64), "h": t.view(np.int64)[con],
                                              "n": suma[g][con]})

    if not tejas:
        return {}
    cuenta = (como_fila(docs.select(texto)).mapInArrow(contar, "g bigint, h bigint, n bigint")
              .groupBy("g", "h").agg(F.sum("n").alias("n")))
    return {(r.g, r.h): r.n for r in cuenta.toLocalIterator()}


def marcar(docs: DataFrame, banco: DataFrame, texto: str = "text", item: str = "item_id",
           texto_item: str = "text", ventana: int = VENTANA,
           palabras_por_bloque: int = PALABRAS_POR_BLOQUE) -> DataFrame:
    """``fila`` (the input row), ``n_palabras``, ``tramos`` (word runs hit, flat: start, end, ...), ``items``.

    Row by row in one scan, however many blocks the benchmark has: repeated rows and null ids are rows
    like others, and a group of copies needs no shuffle.  Null or empty text has no words; a benchmark
    without rows or words marks nothing; a null ``item_id`` marks words without naming an item.
    """
    campo = docs.columns.index(texto)
    tipo = StructType([StructField("fila", docs.schema, False), StructField("n_palabras", LongType()),
                       StructField("tramos", ArrayType(LongType())), StructField("items", ArrayType(StringType()))])
    df = como_fila(docs)
    primero = True
    for bloque in _bloques(banco, item, texto_item, ventana, palabras_por_bloque):
        bloque.ordenar(_contar_tejas(docs, texto, bloque))
        df = df.mapInArrow(_marcador(docs.sparkSession.sparkContext.broadcast(bloque), campo, primero), tipo)
        primero = False
    return df


def _marcador(bloque, campo: int, primero: bool):
    def paso(lote: pa.RecordBatch) -> pa.RecordBatch:
        b = bloque.value
        p = Palabras(textos(lote, campo), ES_PALABRA)
        h = p.huellas()
        v, s = b.lugares(p, h)
        marca = np.zeros(len(h) + 1, np.int64)
        np.add.at(marca, s, 1)
        np.add.at(marca, s + b.largo[v], -1)
        items: list[set] = [set() for _ in range(lote.num_rows)]
        for d, w in np.unique(np.stack([p.doc[s], v]), axis=1).T.tolist():
            items[d] |= b.de_item[w] - {None}
        if not primero:
            for d, (pares, otros) in enumerate(zip(lote.column(2).to_pylist(), lote.column(3).to_pylist())):
                items[d] |= set(otros)
                for k in range(0, len(pares), 2):
                    marca[p.primera[d] + pares[k]] += 1
                    marca[p.primera[d] + pares[k + 1]] -= 1
        dado = np.cumsum(marca)[:-1] > 0
        antes = np.zeros(len(h), bool)
        antes[1:] = dado[:-1] & (p.doc[1:] == p.doc[:-1])
        luego = np.zeros(len(h), bool)
        luego[:-1] = dado[1:] & (p.doc[1:] == p.doc[:-1])
        a, z = np.flatnonzero(dado & ~antes), np.flatnonzero(dado & ~luego)
        de = p.doc[a]
        plano = np.stack([a - p.primera[de], z + 1 - p.primera[de]], axis=1).reshape(-1)
        off = np.zeros(lote.num_rows + 1, np.int32)
        off[1:] = 2 * np.cumsum(np.bincount(de, minlength=lote.num_rows))
        return pa.RecordBatch.from_arrays(
            [lote.column(0), pa.array(p.n), pa.ListArray.from_arrays(pa.array(off), pa.array(plano, pa.int64())),
             pa.array([sorted(x) for x in items], pa.list_(pa.string()))], ["fila", "n_palabras", "tramos", "items"])

    def aplicar(lotes: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        soltar()
        for lote in lotes:
            yield from map(paso, cortar(lote, campo))
    return aplicar


N_DADAS = "aggregate(transform(tramos, (x, i) -> IF(i % 2 = 0, -x, x)), 0L, (a, x) -> a + x)"


def contaminado():
    """A text is contaminated if one word in twenty or more stands in a benchmark window."""
    return F.expr("n_dadas > 0 AND 20 * n_dadas >= n_palabras")


def medir(docs: DataFrame, banco: DataFrame, **opciones) -> DataFrame:
    """``marcar`` with ``n_dadas`` and the verdict ``contaminado``."""
    return (marcar(docs, banco, **opciones).withColumn("n_dadas", F.expr(N_DADAS))
            .withColumn("contaminado", contaminado()))


def limpios(docs: DataFrame, banco: DataFrame, **opciones) -> DataFrame:
    """The rows of ``docs``, all columns, that are not contaminated."""
    return medir(docs, banco, **opciones).filter(~F.col("contaminado")).select("fila.*")
