"""Runs of repeated words, found on an enhanced suffix array.

A run is a stretch of consecutive words with smallest period q that no neighbouring word extends and that is at least
``veces`` periods long.  The words of many texts share one suffix array whose first key is the text, so that suffixes of
two texts have nothing in common.  For each interval of equal prefixes, depth l, the suffixes i of all children but the
largest are tested against i + l and i - l: if the other one is in the interval as well and the words after the two
differ, they start a branching tandem of period l (Stoye & Gusfield, TCS 2002).  Each run ends in exactly one branching
tandem of its period.  Tandems are rotated to the left as far as words repeat and merged into runs; multiples of a
period give the same stretch and are merged with it.  Intervals are index ranges, no tree is built.

Row by row: null or empty text has no words and no run, repeated rows are rows of their own, an empty table gives an
empty result.  A step works on a few megabytes of text; a longer text is a step of its own and is never cut.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from comanda.llm.comun import ES_NO_BLANCO, Palabras, como_fila, cortar, textos

#: Suffixes tested at once.
PRUEBAS_POR_PASO = 1 << 20
#: Rounds of pointer jumping before the tree of minima is built.
SALTOS = 12
CORRIDA = StructType([StructField(c, LongType(), False) for c in ("inicio", "largo", "periodo")])


def sufijos(palabra: np.ndarray, texto: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Suffix array, its inverse and the words in common with the suffix before, of many texts at once.

    ``palabra`` numbers the words and ``texto`` their texts, in order.  Ranks by the first word are refined to ranks by
    2, 4, 8 ... words; only suffixes that still share their rank take part.  Their ranks at each length are kept until
    the common words of neighbours are read off them.
    """
    n = len(palabra)
    clave = texto * (int(palabra.max(initial=0)) + 1) + palabra
    sa = np.argsort(clave, kind="stable")
    nueva = np.ones(n, bool)
    nueva[1:] = clave[sa][1:] != clave[sa][:-1]
    rango = np.empty(n, np.int64)
    rango[sa] = np.maximum.accumulate(np.where(nueva, np.arange(n), 0))
    # the suffix that starts behind the last word of a text is less than all others
    fin = np.empty(n, np.int64)
    fin[:] = np.searchsorted(texto, texto, "right")
    niveles, h = [], 1
    while True:
        # places of the array that share their rank with a neighbour
        junto = ~nueva
        junto[:-1] |= ~nueva[1:]
        lugar = np.flatnonzero(junto)
        if not len(lugar):
            break
        i = sa[lugar]
        r = rango[i]
        niveles.append((i, r.astype(np.int32)))
        sigue = i + h
        otro = np.where(sigue < fin[i], rango[np.minimum(sigue, n - 1)] + 1, 0)
        orden = np.lexsort((otro, r))
        i, r, otro = i[orden], r[orden], otro[orden]
        sa[lugar] = i
        abre = np.ones(len(i), bool)
        abre[1:] = (r[1:] != r[:-1]) | (otro[1:] != otro[:-1])
        nueva[lugar] = abre
        rango[i] = np.maximum.accumulate(np.where(abre, lugar, 0))
        h *= 2
    return sa, rango, _comunes(sa, niveles, n)


def _comunes(sa: np.ndarray, niveles: list, n: int) -> np.ndarray:
    """Words in common with the suffix before, by binary steps from the longest length that any two share."""
    lcp = np.zeros(n, np.int64)
    a, b = sa[:-1].copy(), sa[1:].copy()
    en = np.arange(1, n)
    rango = np.empty(n + 1, np.int32)
    for k in range(len(niveles) - 1, -1, -1):
        i, r = niveles[k]
        # a suffix without a rank here shares so many words with none
        rango[:] = -1
        rango[i] = r
        ra = rango[np.minimum(a, n)]
        igual = (ra >= 0) & (ra == rango[np.minimum(b, n)])
        lcp[en[igual]] += 1 << k
        a[igual] += 1 << k
        b[igual] += 1 << k
    return lcp


def _menor_antes(v: np.ndarray) -> np.ndarray:
    """Place of the nearest smaller value before each one, -1 where there is none: by a few rounds of pointer jumping,
    and for the others, which look down long stairs, by climbing a tree of block minima."""
    p = np.arange(len(v)) - 1
    vivos = np.arange(len(v))
    for _ in range(SALTOS):
        vivos = vivos[(p[vivos] >= 0)]
        vivos = vivos[v[p[vivos]] >= v[vivos]]
        if not len(vivos):
            return p
        p[vivos] = p[p[vivos]]
    minimos = [v]
    while len(minimos[-1]) > 1:
        m = minimos[-1]
        m = np.append(m, np.iinfo(np.int64).max) if len(m) % 2 else m
        minimos.append(np.minimum(m[::2], m[1::2]))
    # nothing between the pointer and the place is smaller, so the search goes on from the pointer itself
    vivos = vivos[p[vivos] >= 0]
    nodo, valor = p[vivos], v[vivos]
    nivel = np.where(v[nodo] < valor, 0, -1)
    for k, m in enumerate(minimos):
        busca = np.flatnonzero(nivel < 0)
        hermano = nodo[busca] - 1
        en = (nodo[busca] & 1 == 1) & (m[np.maximum(hermano, 0)] < valor[busca])
        nodo[busca] = np.where(en, hermano, nodo[busca] >> 1)
        nivel[busca[en]] = k
    for k in range(len(minimos) - 1, 0, -1):
        baja = np.flatnonzero(nivel == k)
        derecho = 2 * nodo[baja] + 1
        m = minimos[k - 1]
        cabe = (derecho < len(m)) & (m[np.minimum(derecho, len(m) - 1)] < valor[baja])
        nodo[baja] = np.where(cabe, derecho, derecho - 1)
        nivel[baja] = k - 1
    p[vivos] = np.where(nivel < 0, -1, nodo)
    return p


def intervalos(lcp: np.ndarray, cabe: np.ndarray, minimo: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Of each interval of at least ``minimo`` suffixes whose depth is at most ``cabe`` (by place), the children but
    the largest: (depth, first and last place of the interval, first place and size of the child)."""
    n = len(lcp)
    t = np.flatnonzero((lcp > 0) & (lcp <= cabe))
    if not len(t):
        return
    # an interval is found at each of its inner borders t: from the nearest smaller value on either side
    izq = np.maximum(_menor_antes(lcp), 0)[t]
    der = (n - 1 - _menor_antes(lcp[::-1])[::-1])[t]
    der = np.where(der >= n, n, der) - 1
    ancho = der - izq + 1 >= minimo
    t, izq, der = t[ancho], izq[ancho], der[ancho]
    if not len(t):
        return
    orden = np.lexsort((t, der, izq))
    t, izq, der = t[orden], izq[orden], der[orden]
    prof = lcp[t]
    abre = np.ones(len(t), bool)
    abre[1:] = (izq[1:] != izq[:-1]) | (der[1:] != der[:-1])
    cabeza = np.flatnonzero(abre)
    grupo = np.cumsum(abre) - 1
    # children: one before the first border, one from each border to the next or to the end
    hasta = np.empty(len(t), np.int64)
    hasta[:-1] = t[1:]
    ultimo = np.append(abre[1:], True)
    hasta[ultimo] = der[ultimo] + 1
    ini = np.concatenate([izq[cabeza], t])
    largo = np.concatenate([t[cabeza] - izq[cabeza], hasta - t])
    de = np.concatenate([np.arange(len(cabeza)), grupo])
    mayor = np.lexsort((-largo, de))
    mayor = mayor[np.unique(de[mayor], return_index=True)[1]]
    queda = np.ones(len(de), bool)
    queda[mayor] = False
    de, ini, largo = de[queda], ini[queda], largo[queda]
    total = np.cumsum(largo)
    i = 0
    while i < len(de):
        j = max(i + 1, int(np.searchsorted(total, (total[i - 1] if i else 0) + PRUEBAS_POR_PASO, "right")))
        d = cabeza[de[i:j]]
        yield prof[d], izq[d], der[d], ini[i:j], largo[i:j]
        i = j


def tandems(palabra: np.ndarray, texto: np.ndarray, fin: np.ndarray, veces: int) -> tuple[np.ndarray, np.ndarray]:
    """(end, period) of the branching tandems that continue to the left for ``veces`` periods in all.

    ``fin`` is the end of each word's text."""
    n = len(palabra)
    sa, isa, lcp = sufijos(palabra, texto)
    ini = np.searchsorted(texto, texto, "left")
    cabe = (fin - ini)[sa] // veces
    fines, periodos = [], []
    for prof, izq, der, primero, largo in intervalos(lcp, cabe, veces):
        de = np.repeat(np.arange(len(largo)), largo)
        i = sa[np.arange(len(de)) - np.repeat(np.cumsum(largo) - largo, largo) + primero[de]]
        p, a, b = prof[de], izq[de], der[de]

        def dentro(x: np.ndarray) -> np.ndarray:
            r = isa[np.clip(x, 0, n - 1)]
            return (x >= 0) & (x < n) & (r >= a) & (r <= b)

        for s, otro in ((i, i + p), (i - p, i - p)):
            # s and s + p are in the interval, and the words behind them differ
            e = s + 2 * p
            tandem = dentro(otro)
            tandem &= (e >= fin[i]) | (palabra[np.clip(s + p, 0, n - 1)] != palabra[np.minimum(e, n - 1)])
            for k in range(1, veces - 1):
                tandem &= dentro(s - k * p)
            fines.append(e[tandem])
            periodos.append(p[tandem])
    if not fines:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    par = np.unique(np.stack([np.concatenate(fines), np.concatenate(periodos)]), axis=1)
    return par[0], par[1]


def _gira(palabra: np.ndarray, desde: int, hasta: int, p: int) -> int:
    """First place from which each word up to ``hasta`` equals the one ``p`` later; not before ``desde``."""
    bloque = 64
    while hasta > desde:
        a = max(desde, hasta - bloque)
        distintas = np.flatnonzero(palabra[a:hasta] != palabra[a + p:hasta + p])
        if len(distintas):
            return a + int(distintas[-1]) + 1
        hasta, bloque = a, 2 * bloque
    return desde


def corridas(palabra: np.ndarray, texto: np.ndarray, minimo: int, veces: int) -> np.ndarray:
    """Runs of at least ``minimo`` words and ``veces`` periods as rows (start, length, period) over all words, sorted."""
    if len(palabra) < minimo:
        return np.zeros((0, 3), np.int64)
    fin = np.searchsorted(texto, texto, "right")
    finales, periodos = tandems(palabra, texto, fin, veces)
    inicio_de = np.searchsorted(texto, texto, "left")
    halladas, previas, ultimo = [], [], -1
    # ends in order, periods rising: a multiple of a period whose run holds the tandem belongs to that run
    for e, p in zip(finales.tolist(), periodos.tolist()):
        if e != ultimo:
            previas, ultimo = [], e
        if any(p % q == 0 and e - s >= 2 * p for s, q in previas):
            continue
        s = _gira(palabra, int(inicio_de[e - 1]), e - p, p)
        previas.append((s, p))
        if e - s >= max(minimo, veces * p):
            halladas.append((s, e - s, p))
    return np.array(sorted(halladas, key=lambda r: (r[0], r[2])), np.int64).reshape(-1, 3)


def _numeros(p: Palabras) -> tuple[pa.Array, np.ndarray]:
    """The words of a batch, each with the blank behind it, and the number of each distinct word."""
    junto, ini, fin = p.seguidas()
    off = np.append(ini, fin[-1] + 1 if len(fin) else 0).astype(np.int64)
    palabras = pa.Array.from_buffers(pa.large_binary(), len(ini), [None, pa.py_buffer(off), pa.py_buffer(junto)])
    return palabras, palabras.dictionary_encode().indices.to_numpy().astype(np.int64)


def _sin_repetir(p: Palabras, palabras: pa.Array, runs: np.ndarray, filas: int) -> pa.Array:
    """The texts' words, one blank between them, without those that a run repeats after its first period."""
    n = len(p.ini)
    sobra = np.zeros(n + 1, np.int64)
    np.add.at(sobra, runs[:, 0] + runs[:, 2], 1)
    np.add.at(sobra, runs[:, 0] + runs[:, 1], -1)
    queda = np.cumsum(sobra)[:n] == 0
    off = np.frombuffer(palabras.buffers()[1], np.int64)[: n + 1]
    letras = np.frombuffer(palabras.buffers()[2], np.uint8)[: off[-1]] if n else np.zeros(0, np.uint8)
    salida = letras[np.repeat(queda, np.diff(off))]
    # one text after the other; the blank behind a text's last word stands between texts and is left out
    largo = np.bincount(p.doc, weights=np.diff(off) * queda, minlength=filas).astype(np.int64)
    fin = np.cumsum(largo)
    entero = pa.py_buffer(salida.tobytes())
    vista = pa.py_buffer(np.append(np.int64(0), fin).astype(np.int64))
    con_blanco = pa.Array.from_buffers(pa.large_string(), filas, [None, vista, entero])
    return pa.compute.utf8_rtrim(con_blanco, " ").cast(pa.string())


def buscar(docs: DataFrame, minimo: int = 6, veces: int = 4, texto: str = "text") -> DataFrame:
    """``fila`` (the input row), ``n_palabras``, ``corridas`` (start, length and period in words, by start and period)
    and ``sin_repetir``: the text's words, one blank between them, each run cut to its first period."""
    campo = docs.columns.index(texto)
    tipo = StructType([StructField("fila", docs.schema, False), StructField("n_palabras", LongType()),
                       StructField("corridas", ArrayType(CORRIDA, False)), StructField("sin_repetir", StringType())])

    def paso(lotes: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lote in (x for y in lotes for x in cortar(y, campo)):
            p = Palabras(textos(lote, campo), ES_NO_BLANCO, igual=True)
            palabras, numero = _numeros(p)
            runs = corridas(numero, p.doc, minimo, veces)
            de = p.doc[runs[:, 0]] if len(runs) else np.zeros(0, np.int64)
            cuantas = np.bincount(de, minlength=lote.num_rows)
            listas = pa.ListArray.from_arrays(
                pa.array(np.append(0, np.cumsum(cuantas)), pa.int32()),
                pa.StructArray.from_arrays([pa.array(runs[:, 0] - p.primera[de] if len(runs) else [], pa.int64()),
                                            pa.array(runs[:, 1], pa.int64()), pa.array(runs[:, 2], pa.int64())],
                                           ["inicio", "largo", "periodo"]))
            yield pa.RecordBatch.from_arrays(
                [lote.column(0), pa.array(p.n, pa.int64()), listas, _sin_repetir(p, palabras, runs, lote.num_rows)],
                ["fila", "n_palabras", "corridas", "sin_repetir"])

    return como_fila(docs).mapInArrow(paso, tipo)
