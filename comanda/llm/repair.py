"""Token ids as shards of grammar-compressed blocks (Re-Pair), decodable text by text.

Each block starts from its ids and replaces the most frequent adjacent pairs by new symbols, again and again,
until no pair stands ``FRECUENCIA`` times.  No pair spans two texts, so every text is a stretch of symbols.  A
block is one binary value: header, text table, rules, expansion length of each rule, symbols; every part is packed at
the bits that its largest number needs.  ``indice`` tells in which block and place a text is, and ``buscar`` decodes the
texts asked for without expanding any other.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from comanda.llm.comun import como_fila, cortar, por_trabajador, textos
from comanda.plans.durable import Corte

MAGIA = 0x32525052
_CABEZA = 11
#: Numbers packed or unpacked at a time.
_TANDA = 1 << 16
#: Ids of a block (a longer text is a block of its own) and the least count of a pair that becomes a rule.
IDS_POR_BLOQUE = 1 << 20
FRECUENCIA = 16
#: Bytes of chunks between blanks and their ids that a worker remembers, and as many again of pre-tokens; none is longer
#: than ``LARGO`` bytes.
RECUERDA = 48 << 20
LARGO = 64
#: Bytes of text that one step works on: the more, the more often a chunk repeats within it.
BYTES_POR_PASO = 16 << 20
#: Pre-tokens that go to the library as one text, and so many of these at a time.
JUNTAS, LLAMADA = 256, 64
#: Buckets that pairs are counted in.
CUBETAS = 1 << 18
_LLANO = re.compile("[!-;=-~À-ÖØ-öø-ÿ]*")
# pre-tokens of plain chunks on a line each; the end of a line is a match of its own
_PRETOKEN = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|\n|[^a-z0-9ß-öø-ÿ\n]+")


# Fixed value: the rules of tokenizer files whose plain chunks are encoded apart.  Files with other rules go to the library.
_REGLAS_LLANAS = {
    "normalizer": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}],
    "pre_tokenizer": [
        {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"},
         "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]}


def _bits(x: np.ndarray) -> int:
    return max(1, int(x.max()).bit_length()) if len(x) else 1


def _largo_en_bytes(n: int, w: int) -> int:
    return -(-n * w // 8)


def empacar(x: np.ndarray, w: int) -> bytes:
    """Numbers from 0, ``w`` bits each, lowest bit first."""
    partes = []
    for i in range(0, len(x), _TANDA):
        b = x[i: i + _TANDA].astype("<u8").view("u1").reshape(-1, 8)
        partes.append(np.packbits(np.unpackbits(b, axis=1, count=w, bitorder="little").ravel(), bitorder="little").tobytes())
    return b"".join(partes)


def desempacar(b: memoryview, w: int, desde: int, hasta: int) -> np.ndarray:
    """Numbers ``desde`` to ``hasta`` of a packed part; only their bytes are read."""
    salida = np.empty(hasta - desde, np.int64)
    for i in range(desde, hasta, _TANDA):
        z = min(i + _TANDA, hasta)
        byte, resto = divmod(i * w, 8)
        u = np.unpackbits(np.frombuffer(b[byte: _largo_en_bytes(z, w)], "u1"), bitorder="little")[resto: resto + (z - i) * w]
        m = np.zeros((z - i, 64), np.uint8)
        m[:, :w] = u.reshape(-1, w)
        salida[i - desde: z - desde] = np.packbits(m, axis=1, bitorder="little").view("<u8").ravel().astype(np.int64)
    return salida


def _cubo(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Bucket of each pair of unsigned 32-bit symbols."""
    return ((a * np.uint32(0x9E3779B1) + b) * np.uint32(0x85EBCA6B) >> np.uint32(14)).astype(np.int64)


def _contar(par: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct pairs in rising order and how often each stands."""
    orden = np.sort(par)
    borde = np.flatnonzero(np.concatenate([[True], orden[1:] != orden[:-1], [True]])) if len(orden) else np.zeros(1, np.int64)
    return orden[borde[:-1]], np.diff(borde)


def comprimir(ids: np.ndarray, fin: np.ndarray, base: int, frecuencia: int = FRECUENCIA) \
        -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rules as (left, right) rows, symbols, last symbol of each text).  Symbol ``base + k`` is rule k.

    A round replaces all pairs at least an eighth as frequent as the most frequent one, of overlapping places
    every other one from the left, so rounds are few.  No pair is more frequent than its bucket, so only pairs of
    buckets that reach the bound are sorted and counted.
    """
    s, corte = ids.astype(np.uint32), fin.copy()
    reglas = [np.zeros((0, 2), np.int64)]
    hechas = 0
    while len(s) > 1:
        h = _cubo(s[:-1], s[1:])
        h[corte[:-1]] = CUBETAS
        en_cubo = np.bincount(h, minlength=CUBETAS + 1)
        en_cubo[CUBETAS] = 0
        if en_cubo.max() < frecuencia:
            break
        de_cubo = en_cubo.astype(np.int32).take(h)

        def llenos(minimo: int) -> tuple[np.ndarray, np.ndarray]:
            donde = np.flatnonzero(de_cubo >= minimo)
            return donde, s.take(donde).astype(np.int64) << 32 | s.take(donde + 1)

        # the fullest bucket's most frequent pair bounds the most frequent of all from below
        cota = int(_contar(llenos(en_cubo.max())[1])[1].max())
        en, par = llenos(max(frecuencia, cota // 8))
        nuevas, veces = _contar(par)
        mayor = int(veces.max(initial=0))
        if mayor < frecuencia:
            break
        nuevas = nuevas[veces >= max(frecuencia, mayor // 8)]
        # a bucket names its pair, if it has one; a bucket of several is searched
        suyo = _cubo((nuevas >> 32).astype(np.uint32), nuevas.astype(np.uint32))
        tabla = np.full(CUBETAS + 1, -1)
        tabla[suyo] = np.arange(len(nuevas))
        tabla[np.bincount(suyo, minlength=CUBETAS + 1) > 1] = len(nuevas)
        k = tabla.take(h.take(en))
        pasa = np.flatnonzero(k >= 0)
        en, par, k = en.take(pasa), par.take(pasa), k.take(pasa)
        varios = np.flatnonzero(k == len(nuevas))
        k[varios] = np.minimum(np.searchsorted(nuevas, par[varios]), len(nuevas) - 1)
        es = np.flatnonzero(nuevas.take(k) == par)
        en, k = en.take(es), k.take(es)
        seguido = np.concatenate([[False], np.diff(en) == 1])
        lugar = np.arange(len(en), dtype=np.int32)
        toma = (lugar - np.maximum.accumulate(np.where(seguido, np.int32(0), lugar))) & 1 == 0
        en = en[toma]
        s[en] = base + hechas + k[toma]
        corte[en] = corte[en + 1]
        queda = np.ones(len(s), bool)
        queda[en + 1] = False
        queda = np.flatnonzero(queda)
        s, corte = s.take(queda), corte.take(queda)
        reglas.append(np.stack([nuevas >> 32, nuevas & 0xFFFFFFFF], axis=1))
        hechas += len(nuevas)
    return np.concatenate(reglas), s, np.flatnonzero(corte)


def largos(reglas: np.ndarray, base: int) -> np.ndarray:
    """Ids that each rule expands to.  A rule uses rules before it only; rounds settle them by depth."""
    n = np.ones(base + len(reglas), np.int64)
    n[base:] = 0
    falta = np.arange(len(reglas))
    while len(falta):
        a, b = n[reglas[falta, 0]], n[reglas[falta, 1]]
        listas = (a > 0) & (b > 0)
        n[base + falta[listas]] = (a + b)[listas]
        falta = falta[~listas]
    return n[base:]


def expandir(s: np.ndarray, reglas: np.ndarray, base: int) -> np.ndarray:
    s = s.astype(np.int64)
    while (nt := s >= base).any():
        lugar = np.cumsum(1 + nt) - 1 - nt
        salida = np.empty(len(s) + int(nt.sum()), np.int64)
        r = reglas[s[nt] - base]
        salida[lugar[~nt]] = s[~nt]
        salida[lugar[nt]], salida[lugar[nt] + 1] = r[:, 0], r[:, 1]
        s = salida
    return s


def _tramos(ini: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Places of stretches one after the other, each from ``ini`` on and ``n`` long."""
    fin = np.cumsum(n)
    return np.repeat(ini - (fin - n), n) + np.arange(int(fin[-1]) if len(fin) else 0)


def expandir_todo(s: np.ndarray, reglas: np.ndarray, largo: np.ndarray, base: int) -> np.ndarray:
    """As ``expandir``, for many symbols: every rule is expanded once, by depth, and symbols copy their stretch.

    ``largo`` is the ids that each rule expands to.  A pair is made a rule where it stands several times, so the rules
    of a round expand to fewer ids than the block has.
    """
    n = np.concatenate([np.ones(base, np.int64), largo])
    ini = np.cumsum(n) - n
    ids = np.zeros(int(n.sum()), "<u4")
    ids[:base] = np.arange(base)
    lista = np.arange(len(n)) < base
    falta = np.arange(len(reglas))
    while len(falta):
        ya = lista[reglas[falta]].all(axis=1)
        k = falta[ya]
        hijos = reglas[k].ravel()
        ids[_tramos(ini[base + k], n[base + k])] = ids[_tramos(ini[hijos], n[hijos])]
        lista[base + k] = True
        falta = falta[~ya]
    return ids[_tramos(ini[s], n[s])]


def a_bytes(docs: list[int | None], ids: list[np.ndarray], base: int) -> bytes:
    largo = np.array([len(x) for x in ids], np.int64)
    todos = np.concatenate(ids) if ids else np.zeros(0, np.int64)
    fin = np.zeros(len(todos), bool)
    fin[np.cumsum(largo) - 1] = True
    reglas, s, ultimos = comprimir(todos, fin, base)
    nulos = np.array([d is None for d in docs], np.int64)
    con = [d for d in docs if d is not None]
    menor = min(con, default=0)
    # differences of any two longs fit 64 bits
    ids_ = np.array([0 if d is None else d - menor for d in docs], np.uint64)
    de_texto = np.diff(ultimos + 1, prepend=0)
    n = largos(reglas, base)
    partes = [nulos, ids_, de_texto, largo, reglas.ravel(), n, s]
    w = [_bits(x) for x in partes]
    cabeza = np.array([MAGIA, base, len(docs), len(reglas), len(s), *w[1:], 0], "<u4")
    return b"".join([cabeza.tobytes(), np.array([menor], "<i8").tobytes(), *map(empacar, partes, w)])


class Bloque:
    """A block read back; decodes whole texts or a stretch of one without the others.  Opening it reads the text table
    and the rules; symbols are unpacked where they are asked for."""

    def __init__(self, b: bytes, solo_tabla: bool = False):
        magia, self.base, n, r, self.n_simbolos, *w, _ = np.frombuffer(b, "<u4", _CABEZA + 1).tolist()
        if magia != MAGIA:
            raise ValueError("not a block of ids")
        en = 4 * (_CABEZA + 1)
        menor = int(np.frombuffer(b, "<i8", 1, en)[0])
        en += 8
        vista = memoryview(b)
        partes = []
        for cuantos, ancho in zip((n, n, n, n, 2 * r, r, self.n_simbolos), (1, *w)):
            partes.append((vista[en: en + _largo_en_bytes(cuantos, ancho)], ancho, cuantos))
            en += _largo_en_bytes(cuantos, ancho)

        def trae(k: int) -> np.ndarray:
            v, ancho, cuantos = partes[k]
            return desempacar(v, ancho, 0, cuantos)

        # an id less the smallest one may take all 64 bits
        self.docs = [None if z else int(d) + menor for d, z in zip(trae(1).view(np.uint64), trae(0))]
        self.hasta, self.largo = np.cumsum(trae(2)), trae(3)
        if not solo_tabla:
            self.reglas, self.expande = trae(4).reshape(-1, 2), trae(5)
        self._simbolos = partes[6]

    def simbolos(self, desde: int = 0, hasta: int | None = None) -> np.ndarray:
        v, ancho, cuantos = self._simbolos
        return desempacar(v, ancho, desde, cuantos if hasta is None else hasta)

    def todos(self) -> np.ndarray:
        return expandir_todo(self.simbolos(), self.reglas, self.expande, self.base)

    def texto(self, k: int, desde: int = 0, hasta: int | None = None) -> np.ndarray:
        """Ids ``desde`` to ``hasta`` of the k-th text: expansion lengths tell which symbols to expand."""
        s = self.simbolos(int(self.hasta[k - 1]) if k else 0, int(self.hasta[k]))
        hasta = int(self.largo[k]) if hasta is None else min(hasta, int(self.largo[k]))
        n = np.ones(len(s), np.int64)
        n[s >= self.base] = self.expande[s[s >= self.base] - self.base]
        fin = np.cumsum(n)
        a, z = np.searchsorted(fin, desde, "right"), np.searchsorted(fin, hasta, "left")
        antes = int(fin[a] - n[a]) if a < len(s) else desde
        return expandir(s[a: z + 1], self.reglas, self.base)[desde - antes: max(hasta, desde) - antes].astype("<u4")


def _lista(ids: list) -> pa.ListArray:
    fin = np.cumsum([0, *map(len, ids)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(fin), pa.array(np.concatenate(ids) if ids else [], pa.uint32()))


def _agrupar(ids: pa.ListArray, fin: np.ndarray) -> pa.ListArray:
    """Lists one after the other made one: ``fin`` are the lists before each new one, and all of them."""
    return pa.ListArray.from_arrays(pa.array(np.asarray(ids.offsets)[fin]), ids.values)


def _nada() -> tuple[pa.Array, pa.ListArray]:
    return pa.array([], pa.string()), _lista([])


class Conocidos:
    """Ids of short texts met before, side by side in two Arrow arrays of ``tope`` bytes at most.  When they are full,
    only the last step's stay."""

    def __init__(self, tope: int):
        self.tope = tope
        self.textos, self.ids = _nada()

    def de(self, t: pa.Array, codificar: Callable[[pa.Array], pa.ListArray]) -> pa.ListArray:
        """Ids of each of the distinct texts ``t``, new ones by ``codificar`` all together."""
        lugar = pc.index_in(t, value_set=self.textos)
        falta = lugar.is_null()
        nuevos = t.filter(falta)
        if not len(nuevos):
            return self.ids.take(lugar)
        de_nuevos, es_nuevo = codificar(nuevos), falta.to_numpy(zero_copy_only=False)
        en = np.where(es_nuevo, len(self.textos) + np.cumsum(es_nuevo) - 1, lugar.fill_null(0).to_numpy(zero_copy_only=False))
        salida = pa.concat_arrays([self.ids, de_nuevos]).take(pa.array(en))
        if self._guardar(self.textos, self.ids, nuevos, de_nuevos) and self._guardar(*_nada(), t, salida):
            self.textos, self.ids = _nada()
        return salida

    def _guardar(self, t: pa.Array, ids: pa.ListArray, mas_t: pa.Array, mas_ids: pa.ListArray) -> bool:
        """Keeps ``t`` and the short ones of ``mas_t``; whether that is too much."""
        breves = pc.less_equal(pc.binary_length(mas_t), LARGO)
        self.textos, self.ids = pa.concat_arrays([t, mas_t.filter(breves)]), pa.concat_arrays([ids, mas_ids.filter(breves)])
        return self.textos.nbytes + self.ids.nbytes > self.tope


class Tokens:
    """Ids of a text by the library, piece by piece.

    The tokenizer composes, lower-cases and splits inside a run without ASCII white space and drops the white
    space, so a text's ids are those of its chunks between blanks, in order.  A chunk of plain Latin letters,
    digits and marks has only one composition and lower case: its pre-tokens are encoded apart, once each, many as the
    words of one text.  Any other chunk, and one that might hold a special token, goes to the library as it stands.
    Chunks and pre-tokens are told apart by Arrow, so Python sees only those that are new to the worker.
    """

    def __init__(self, ruta: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.lib = Tokenizer.from_file(ruta)
        self.base = self.lib.get_vocab_size(with_added_tokens=True)
        self.trozos, self.piezas = Conocidos(RECUERDA), Conocidos(RECUERDA)
        de_ruta = json.loads(self.lib.to_str())
        self.llana = all((de_ruta.get(k) or {}).get(c) == _REGLAS_LLANAS[k] for k, c in (
            ("normalizer", "normalizers"), ("pre_tokenizer", "pretokenizers")))

    def _biblioteca(self, t: list[str]) -> Iterator[np.ndarray]:
        for e in self.lib.encode_batch_fast(t, add_special_tokens=False):
            yield np.array(e.ids, "<u4")

    def _piezas(self, nuevas: pa.Array) -> pa.ListArray:
        """Ids of pre-tokens of plain chunks.  The library says which word of a text a token is of."""
        x, partes = nuevas.to_pylist(), []
        for a in range(0, len(x), JUNTAS * LLAMADA):
            tanda = x[a: a + JUNTAS * LLAMADA]
            grupos = [" ".join(tanda[b: b + JUNTAS]) for b in range(0, len(tanda), JUNTAS)]
            ids, de, cuantos = [], [], []
            for e in self.lib.encode_batch(grupos, add_special_tokens=False):
                ids += e.ids
                de += e.word_ids
                cuantos.append(len(de))
            # every group but the last has as many words
            n = (np.bincount(np.array(de) + np.repeat(np.arange(len(grupos)) * JUNTAS, np.diff(cuantos, prepend=0)),
                             minlength=len(tanda)) if de and None not in de else np.zeros(0, np.int64))
            if len(n) == len(tanda) and n.all():
                partes.append(pa.ListArray.from_arrays(pa.array(np.cumsum([0, *n]).astype(np.int32)), pa.array(ids, pa.uint32())))
            else:
                partes.append(_lista(list(self._biblioteca(tanda))))
        return pa.concat_arrays(partes)

    def _trozos(self, nuevos: pa.Array) -> pa.ListArray:
        t = nuevos.to_pylist()
        llano = np.full(len(t), _LLANO.fullmatch("".join(t)) is not None)
        if not llano.all():
            llano = np.array([_LLANO.fullmatch(x) is not None for x in t])
        raros = _lista(list(self._biblioteca([t[i] for i in np.flatnonzero(~llano).tolist()])))
        if not llano.any():
            return raros
        juntos = "\n".join([*(t if llano.all() else [t[i] for i in np.flatnonzero(llano).tolist()]), ""])
        piezas = pa.array(_PRETOKEN.findall(juntos.lower()), pa.string())
        acaba = pc.equal(piezas, "\n")
        fin = np.flatnonzero(acaba.to_numpy(zero_copy_only=False))
        ids = self._por_distintos(self.piezas, piezas.filter(pc.invert(acaba)), self._piezas)
        llanos = _agrupar(ids, np.concatenate([[0], fin - np.arange(len(fin))]))
        orden = np.where(llano, np.cumsum(llano) - 1, len(fin) + np.cumsum(~llano) - 1)
        return pa.concat_arrays([llanos, raros]).take(pa.array(orden))

    @staticmethod
    def _por_distintos(memo: Conocidos, t: pa.Array, codificar: Callable) -> pa.ListArray:
        d = t.dictionary_encode()
        return memo.de(d.dictionary, codificar).take(d.indices)

    def ids(self, t: pa.Array) -> pa.ListArray:
        """Ids of each text."""
        if not self.llana:
            return _lista(list(self._biblioteca(t.to_pylist())))
        trozos = pc.ascii_split_whitespace(t)
        return _agrupar(self._por_distintos(self.trozos, trozos.flatten(), self._trozos),
                        np.asarray(trozos.offsets) - trozos.offsets[0].as_py())

    def textos(self, t: list[str]) -> list[bytes]:
        ids = self.ids(pa.array(t, pa.string()))
        v, o = ids.values.to_numpy(), np.asarray(ids.offsets).tolist()
        return [v[a:z].astype("<u4").tobytes() for a, z in zip(o, o[1:])]


def tokens(ruta: str) -> Tokens:
    """One per Python worker, so its memory lasts over tasks."""
    return por_trabajador(("tokens", ruta), lambda: Tokens(ruta))


def escribir(docs: DataFrame, codificador: Callable[[], Tokens], id_doc: str = "doc_id", texto: str = "text",
             fin: int = 2, ids_por_bloque: int = IDS_POR_BLOQUE, salida: str | None = None) -> DataFrame:
    """Writes the blocks and returns them as read back: (parte, bloque, n_ids, contenido), in order of both.

    ``salida`` is the new folder that they are written to and stay in; without one it is a scratch folder.

    Texts go by id, null first; equal ids by text hash, then text, so repeated rows have a defined order.  They
    are dealt out by ranges of id and hash: neither many rows with one id nor copies fill a range alone.  Null
    text is empty and has only the end id.
    """
    if not isinstance(docs.schema[id_doc].dataType, IntegralType):
        raise ValueError(f"{id_doc} must be a whole number")
    f = docs.select(F.col(id_doc).cast("bigint").alias("id"), F.coalesce(F.col(texto), F.lit("")).alias("t"))
    h = F.xxhash64("t")
    f = f.repartitionByRange(F.col("id").asc_nulls_first(), h).sortWithinPartitions(F.col("id").asc_nulls_first(), h, "t")

    def guardar(lotes: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c, parte, bloque = codificador(), TaskContext.get().partitionId(), 0
        docs_, ids, n = [], [], 0

        def cierra() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"parte": pa.array([parte], pa.int64()), "bloque": pa.array([bloque], pa.int64()),
                                               "n_ids": pa.array([n], pa.int64()),
                                               "contenido": pa.array([a_bytes(docs_, ids, c.base)], pa.binary())})

        for lote in (x for y in lotes for x in cortar(y, 1, BYTES_POR_PASO)):
            de_lote = c.ids(textos(lote, 1))
            acaba = np.asarray(de_lote.offsets)[1:]
            con_fin = np.insert(de_lote.values.to_numpy().astype("<u4"), acaba, fin)
            hasta = acaba + np.arange(1, len(acaba) + 1)
            for d, a, z in zip(lote.column(0).field(0).to_pylist(), [0, *hasta[:-1].tolist()], hasta.tolist()):
                x = con_fin[a:z]
                if n and n + len(x) > ids_por_bloque:
                    yield cierra()
                    docs_, ids, n, bloque = [], [], 0, bloque + 1
                docs_.append(d)
                ids.append(x)
                n += len(x)
        if n:
            yield cierra()

    df = como_fila(f).mapInArrow(guardar, "parte bigint, bloque bigint, n_ids bigint, contenido binary")
    if salida is not None:
        df.write.parquet(salida)
        return docs.sparkSession.read.schema(df.schema).parquet(salida)
    return Corte(docs.sparkSession, "ids").guardar(df)[0]


def inicios(bloques: DataFrame) -> DataFrame:
    """(parte, bloque, inicio): ids before each block, from one row a block and then one a part."""
    previo = Window.orderBy("parte").rowsBetween(Window.unboundedPreceding, -1)
    partes = (bloques.groupBy("parte").agg(F.sum("n_ids").alias("n"))
              .select("parte", F.coalesce(F.sum("n").over(previo), F.lit(0)).alias("antes")))
    dentro = Window.partitionBy("parte").orderBy("bloque").rowsBetween(Window.unboundedPreceding, -1)
    return (bloques.select("parte", "bloque", F.coalesce(F.sum("n_ids").over(dentro), F.lit(0)).alias("en_parte"))
            .join(partes, "parte").select("parte", "bloque", (F.col("antes") + F.col("en_parte")).alias("inicio")))


def leer(bloques: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every text, from the decoded blocks."""
    con = bloques.join(inicios(bloques), ["parte", "bloque"]).select("contenido", "inicio")

    def decodificar(lotes: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lote in lotes:
            for f in lote.column(0):
                b = Bloque(f["contenido"].as_py())
                ids, z = b.todos(), np.cumsum(b.largo)
                a = z - b.largo
                suma = [zlib.crc32(ids[x:y].tobytes()) for x, y in zip(a.tolist(), z.tolist())]
                yield pa.RecordBatch.from_pydict({
                    "doc_id": pa.array(b.docs, pa.int64()), "start": pa.array(a + f["inicio"].as_py()),
                    "n_tokens": pa.array(b.largo), "ids_crc32": pa.array(suma, pa.int64())})

    return como_fila(con).mapInArrow(decodificar, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def indice(bloques: DataFrame) -> DataFrame:
    """(doc_id, parte, bloque, lugar, n_tokens): where each text is, from the text tables alone."""
    def tabla(lotes: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lote in lotes:
            for f in lote.column(0):
                b = Bloque(f["contenido"].as_py(), solo_tabla=True)
                n = len(b.docs)
                yield pa.RecordBatch.from_pydict({
                    "doc_id": pa.array(b.docs, pa.int64()), "parte": pa.array(np.full(n, f["parte"].as_py(), np.int64)),
                    "bloque": pa.array(np.full(n, f["bloque"].as_py(), np.int64)), "lugar": pa.array(np.arange(n)),
                    "n_tokens": pa.array(b.largo)})

    return como_fila(bloques.select("parte", "bloque", "contenido")).mapInArrow(
        tabla, "doc_id bigint, parte bigint, bloque bigint, lugar bigint, n_tokens bigint")


def buscar(bloques: DataFrame, lugares: DataFrame, pedidos: DataFrame, desde: int = 0, hasta: int | None = None) -> DataFrame:
    """(doc_id, parte, bloque, lugar, ids): ids ``desde`` to ``hasta`` of every text whose id is in ``pedidos(doc_id)``.

    ``lugares`` is ``indice``, best written beside the blocks.  Places are gathered per block (a block holds at most
    ``IDS_POR_BLOQUE`` texts), so a block travels once however many of its texts are asked for, and others not at all.
    An id of several rows gives all of them, an unknown id none, a null id the texts without an id.
    """
    p = pedidos.select(F.col("doc_id").alias("_pedido")).distinct()
    por_bloque = (lugares.join(p, lugares["doc_id"].eqNullSafe(p["_pedido"]), "left_semi").groupBy("parte", "bloque")
                  .agg(F.sort_array(F.collect_list("lugar")).alias("lugares")))
    con = bloques.select("parte", "bloque", "contenido").join(por_bloque, ["parte", "bloque"])

    def decodificar(lotes: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lote in lotes:
            for f in lote.column(0):
                b = Bloque(f["contenido"].as_py())
                for k in f["lugares"].as_py():
                    yield pa.RecordBatch.from_pydict({
                        "doc_id": pa.array([b.docs[k]], pa.int64()), "parte": pa.array([f["parte"].as_py()], pa.int64()),
                        "bloque": pa.array([f["bloque"].as_py()], pa.int64()), "lugar": pa.array([k], pa.int64()),
                        "ids": pa.array([b.texto(k, desde, hasta).astype(np.int64)], pa.list_(pa.int64()))})

    return como_fila(con).mapInArrow(decodificar, "doc_id bigint, parte bigint, bloque bigint, lugar bigint, ids array<bigint>")
