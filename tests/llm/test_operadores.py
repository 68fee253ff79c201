"""Text operators against brute force, exact round trips and held-out accuracy, with awkward rows in each."""

import base64
import hashlib
import json
import random
import re
import tracemalloc
import uuid
import zlib
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import public_tokenizers as vocabularios
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from comanda.llm import bpe, chat, comun, descontaminacion, idioma, licencias, oraculo, reglas, repair, simhash, viterbi, warc
from comanda.plans.durable import carpeta_compartida

AZAR = random.Random(5)
PALABRAS = "the of and licence mit license apache general public red blue green stone river cloud señor año".split()
PAT = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
FRASE = "Alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho"


def prosa(n):
    return " ".join(AZAR.choice(PALABRAS) for _ in range(n))


LARGO = " ".join(f"w{i % 9973} q{i}" for i in range(60_000))
TEXTOS = [
    None, "", " \n\t ", "!!! ???", "a", "Mit license", "x " * 400, prosa(300), prosa(300), FRASE, "intro " + FRASE + " end",
    FRASE + ". " + prosa(400), "Released under the MIT License.", LARGO, "één 世界 🙂 a\x00b", prosa(60) + "\n" + prosa(60),
    "line one two three four five six seven eight\n" * 6, "a" * 3000, "<|im_end|> <0x0A> <s>"]
FILAS = [(i, t, "en" if i % 2 else None) for i, t in enumerate(TEXTOS)] + [
    (7, TEXTOS[7], "en"), (None, "no id here", None), (None, None, None), (100, TEXTOS[7], "fr")]
# columns whose names the operators use themselves
ESQUEMA = "doc_id bigint, text string, lang string, n bigint, huella string, fila int, clave string, idioma string"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(*f, 1, "x", 2, "k", "zz") for f in FILAS], ESQUEMA).repartition(3)


@pytest.fixture(scope="module")
def vacia(docs):
    return docs.limit(0)


@pytest.fixture(scope="module")
def banco(spark):
    return spark.createDataFrame([("7", FRASE), ("10", "Blue river"), ("9", None), (None, "green stone red the"), ("8", ""),
                                  ("11", FRASE), ("11", FRASE)], "item_id string, text string")


def palabras(t):
    return PAT.findall((t or "").encode().lower())


def contaminacion(t, items):
    w, dadas, quienes = palabras(t), set(), set()
    for i, x in items:
        v = palabras(x)
        m = min(13, len(v))
        for s in range(len(v) - m + 1) if v else ():
            for p in range(len(w) - m + 1):
                if w[p: p + m] == v[s: s + m]:
                    dadas |= set(range(p, p + m))
                    quienes |= {i} - {None}
    return len(w), len(dadas), sorted(quienes), bool(dadas) and 20 * len(dadas) >= len(w)


@pytest.mark.parametrize("bloque", [500_000, 10])
def test_descontaminacion(docs, banco, bloque):
    items = [tuple(r) for r in banco.collect()]
    m = descontaminacion.medir(docs, banco, palabras_por_bloque=bloque).collect()
    assert len(m) == len(FILAS)
    for r in m:
        if r.fila.text != LARGO:
            assert (r.n_palabras, r.n_dadas, r["items"], r.contaminado) == contaminacion(r.fila.text, items)


def test_descontaminacion_sin_filas(docs, vacia, banco):
    assert descontaminacion.medir(vacia, banco).count() == 0
    assert descontaminacion.medir(docs, banco.limit(0)).filter("n_dadas > 0 OR contaminado").count() == 0
    limpios = descontaminacion.limpios(docs, banco)
    assert limpios.columns == docs.columns and 0 < limpios.count() < len(FILAS)


def test_licencias(docs, vacia):
    assert licencias.examinar(vacia).count() == 0
    mit = licencias.PLANTILLAS["mit-text"]
    lleno = re.sub(r"<<var[^>]*>>", "Some Authors", re.sub(r"<<beginOptional>>.*?<<endOptional>>", "", mit, flags=re.S))
    a = licencias.Automata(licencias.PLANTILLAS)
    assert a.aceptadas(licencias._palabras("x " + lleno + " y")) == {"mit-text"}
    assert not a.aceptadas(licencias._palabras(lleno.replace("sublicense", "sell")))
    for r in licencias.examinar(docs).collect():
        w = palabras(r.fila.text)
        lugares = sorted(i for f in licencias.FRASES for i in range(len(w)) if w[i: i + len(f.split())] == f.encode().split())
        t = " " + b" ".join(w).decode() + " "
        propias = {n for n, x in licencias.PLANTILLAS.items() if re.search(licencias.expresion(x), t)}
        assert (r.n_palabras, r.lugares) == (len(w), lugares)
        assert r.etiquetas == sorted(propias | set(r.base))


BSD = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
%s
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS ``AS IS''
AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE
FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL
DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR
SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER
CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY,
OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE
OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
BSD_3 = """3. Neither the name of Example Corp. nor the names of its contributors may be used to endorse or promote
products derived from this software without specific prior written permission."""
ISC = """Permission to use, copy, modify, %s distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES
WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF
MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR
ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES
WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN
ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF
OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
APACHE = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at
    http://www.apache.org/licenses/LICENSE-2.0
Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License."""
GPL_3 = """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.
This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details.
You should have received a copy of the GNU General Public License
along with this program.  If not, see <https://www.gnu.org/licenses/>."""
LGPL_21 = """This library is free software; you can redistribute it and/or
modify it under the terms of the GNU Lesser General Public
License as published by the Free Software Foundation; either
version 2.1 of the License, or (at your option) any later version.
This library is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the GNU
Lesser General Public License for more details.
You should have received a copy of the GNU Lesser General Public
License along with this library; if not, write to the Free Software
Foundation, Inc., 51 Franklin Street, Fifth Floor, Boston, MA  02110-1301  USA"""
SIN_LICENCIA = """This is free and unencumbered software released into the public domain.
Anyone is free to copy, modify, publish, use, compile, sell, or
distribute this software, either in source code form or as a compiled
binary, for any purpose, commercial or non-commercial, and by any
means.
In jurisdictions that recognize copyright laws, the author or authors
of this software dedicate any and all copyright interest in the
software to the public domain. We make this dedication for the benefit
of the public at large and to the detriment of our heirs and
successors. We intend this dedication to be an overt act of
relinquishment in perpetuity of all present and future rights to this
software under copyright law.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND,
EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF
MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.
IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR
OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE,
ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR
OTHER DEALINGS IN THE SOFTWARE.
For more information, please refer to <https://unlicense.org>"""


@pytest.mark.parametrize("nombre,texto,de,a", [
    ("bsd-conditions", BSD % BSD_3, "POSSIBILITY OF SUCH", "CERTAINTY OF SUCH"),
    ("bsd-conditions", BSD % "", "STRICT LIABILITY", "LIABILITY"),
    ("isc-text", ISC % "and", "TORTIOUS ACTION", "ACTION"),
    ("isc-text", ISC % "and/or", "PERFORMANCE OF", "SALE OF"),
    ("apache-2.0-header", APACHE, "permissions and", "permissions or"),
    ("gpl-header", GPL_3, "either version 3", "either edition 3"),
    ("gpl-header", GPL_3.replace("either ", "").replace(", or\n(at your option) any later version", ""),
     "WITHOUT ANY WARRANTY", "WITH A WARRANTY"),
    ("gpl-header", LGPL_21, "MERCHANTABILITY or", "MERCHANTABILITY and"),
    ("public-domain", SIN_LICENCIA, "OTHER DEALINGS", "SALES"),
])
def test_licencias_hasta_el_final(nombre, texto, de, a):
    """Texts written apart from the templates; a word changed near the end takes the label away."""
    automata = licencias.Automata(licencias.PLANTILLAS)
    assert nombre in automata.aceptadas(licencias._palabras("x " + texto + " y"))
    assert de in texto and nombre not in automata.aceptadas(licencias._palabras(texto.replace(de, a)))
    assert nombre not in automata.aceptadas(licencias._palabras(ISC % ""))


def test_automata_contra_expresiones():
    """Random templates with nested optional and replaceable regions against the regular expression."""
    g = random.Random(3)
    for _ in range(300):
        partes = ["a"]
        for _ in range(g.randint(1, 5)):
            partes.append(g.choice(["a", "b", "c", '<<var;match=".{0,2}">>', '<<var;match=".{1,3}">>', '<<var;match="a|c">>',
                                    "<<beginOptional>>b<<endOptional>>",
                                    "<<beginOptional>>b <<beginOptional>>c<<endOptional>> a<<endOptional>>"]))
        t = " ".join(partes)
        a, e = licencias.Automata({"x": t}), re.compile(licencias.expresion(t))
        for _ in range(20):
            w = [g.choice("abc") for _ in range(g.randint(0, 9))]
            assert bool(a.aceptadas([x.encode() for x in w])) == bool(e.search(" " + " ".join(w) + " ")), (t, w)


def test_reparacion_ida_y_vuelta(docs, vacia):
    ruta = vocabularios.path("word_bpe_49k.json")
    lib = repair.tokens(ruta).lib
    assert repair.leer(repair.escribir(vacia, lambda: repair.tokens(ruta))).count() == 0
    got = repair.leer(repair.escribir(docs, lambda: repair.tokens(ruta), ids_por_bloque=500)).orderBy("start").collect()
    orden = [r.doc_id for r in got]
    assert orden == sorted(orden, key=lambda x: (x is not None, x or 0)) and len(got) == len(FILAS)
    assert [r.start for r in got] == np.cumsum([0] + [r.n_tokens for r in got])[:-1].tolist()
    quedan = {}
    for i, t, _ in FILAS:
        ids = np.array(lib.encode(t or "", add_special_tokens=False).ids + [2], "<u4")
        quedan.setdefault(i, []).append((len(ids), zlib.crc32(ids.tobytes())))
    leido = {}
    for r in got:
        leido.setdefault(r.doc_id, []).append((r.n_tokens, r.ids_crc32))
    assert {k: sorted(v) for k, v in leido.items()} == {k: sorted(v) for k, v in quedan.items()}


def test_gramatica():
    g = np.random.default_rng(1)
    textos = [g.integers(0, 4, n) for n in (1, 5000, 3, 700, 1, 64)] + [np.zeros(300, np.int64), np.tile([1, 2, 3], 400)]
    b = repair.Bloque(repair.a_bytes([None, 5, 6, 7, 8, 9, 10, 11], textos, 50))
    assert b.docs == [None, 5, 6, 7, 8, 9, 10, 11] and b.n_simbolos < sum(map(len, textos)) / 2
    assert (b.todos() == np.concatenate(textos)).all()
    for k, t in enumerate(textos):
        assert (b.texto(k) == t).all()
        for a, z in ((0, 1), (len(t) // 3, len(t) // 2), (len(t) - 1, len(t)), (2, 2)):
            assert (b.texto(k, a, z) == t[a:z]).all()


def test_empacado():
    g = np.random.default_rng(2)
    for w in (1, 5, 8, 16, 17, 33, 63):
        x = g.integers(0, 1 << w, 70_001)
        b = memoryview(repair.empacar(x, w))
        assert len(b) == -(-len(x) * w // 8)
        for a, z in ((0, len(x)), (0, 0), (3, 4), (65_530, 65_550), (70_000, 70_001)):
            assert (repair.desempacar(b, w, a, z) == x[a:z]).all()
    lejos = [-(1 << 63), None, 0, (1 << 63) - 1]
    assert repair.Bloque(repair.a_bytes(lejos, [np.array([k]) for k in range(4)], 9)).docs == lejos
    # blocks are smaller than the same ids at 16 bits
    frases = [g.integers(0, 49_000, 12) for _ in range(300)]
    textos = [np.concatenate([frases[k] for k in g.integers(0, 300, 20)]) for _ in range(400)]
    bloque = repair.a_bytes(list(range(400)), textos, 49_408)
    assert len(bloque) < sum(map(len, textos)) * 2 / 4
    assert (repair.Bloque(bloque).todos() == np.concatenate(textos)).all()


def test_reparacion_por_id(spark, docs):
    ruta = vocabularios.path("word_bpe_49k.json")
    salida = f"{carpeta_compartida(spark)}/ids_{uuid.uuid4().hex}"
    escritos = repair.escribir(docs, lambda: repair.tokens(ruta), ids_por_bloque=500, salida=salida)
    lugares, lib = repair.indice(escritos), repair.tokens(ruta).lib
    assert lugares.count() == len(FILAS) and spark.read.parquet(salida).count() == escritos.count() > 3
    pedidos = spark.createDataFrame([(7,), (7,), (13,), (None,), (4040,)], "doc_id bigint")
    for a, z in ((0, None), (2, 9)):
        got = repair.buscar(escritos, lugares, pedidos, a, z).collect()
        espera = [(i, (lib.encode(t or "", add_special_tokens=False).ids + [2])[a:z]) for i, t, _ in FILAS if i in (7, 13, None)]
        assert sorted(map(repr, ((r.doc_id, r.ids) for r in got))) == sorted(map(repr, espera))
    with pytest.raises(ValueError):
        repair.escribir(docs.withColumn("doc_id", F.lit("x")), lambda: repair.tokens(ruta))


def test_otra_regla(tmp_path):
    """A file with another split rule goes to the library."""
    t = repair.Tokens(vocabularios.path("word_bpe_49k.json"))
    assert t.llana
    otra = json.loads(t.lib.to_str())
    otra["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"] = "[a-z]{1,3}|[^a-z\\s]"
    (tmp_path / "otra.json").write_text(json.dumps(otra))
    u = repair.Tokens(str(tmp_path / "otra.json"))
    assert not u.llana
    for x, b in zip(TEXTOS[1:9], u.textos(TEXTOS[1:9])):
        assert np.frombuffer(b, "<u4").tolist() == u.lib.encode(x, add_special_tokens=False).ids


def test_tokens_por_trozos():
    t = repair.tokens(vocabularios.path("word_bpe_49k.json"))
    letras = "aBc É ß\n\t'sRe1é世İΣ🙂́ !?,.<|>0\x1c\xa0 Ÿ½²"
    textos = ["".join(AZAR.choice(letras) for _ in range(AZAR.randint(0, 80))) for _ in range(400)] + ["<|endoftext|>x", "<|ENDOFTEXT|>"]
    for x, b in zip(textos, t.textos(textos)):
        assert np.frombuffer(b, "<u4").tolist() == t.lib.encode(x, add_special_tokens=False).ids


def test_tokens_conocidos():
    """Only new pre-tokens reach the library, many in one text; a full memory keeps the last step and gives the same ids."""
    t = repair.Tokens(vocabularios.path("word_bpe_49k.json"))
    lib, dados = t.lib, []

    class Cuenta:
        def encode_batch(self, x, **k):
            dados.extend(x)
            return lib.encode_batch(x, **k)

        def encode_batch_fast(self, x, **k):
            dados.extend(x)
            return lib.encode_batch_fast(x, **k)

    t.lib = Cuenta()
    palabras = ["".join(AZAR.choice("abcdeé") for _ in range(9)) for _ in range(2000)]
    textos = [" ".join(AZAR.choices(palabras, k=300)) + "\x0b\x0c,\r" + "z" * 100 for _ in range(40)]
    queda = [lib.encode(x, add_special_tokens=False).ids for x in textos]
    for _ in range(2):
        assert [np.frombuffer(b, "<u4").tolist() for b in t.textos(textos)] == queda
    assert len(dados) < 2000 // 16
    for tope in (1, 3000, 20_000):
        t.trozos, t.piezas = repair.Conocidos(tope), repair.Conocidos(tope)
        for k in range(0, 40, 4):
            assert [np.frombuffer(b, "<u4").tolist() for b in t.textos(textos[k:k + 4])] == queda[k:k + 4]
            assert t.trozos.textos.nbytes + t.trozos.ids.nbytes <= max(tope, 100)


def test_expandir_todo():
    """Rules expanded once give what rounds of replacing give."""
    g = np.random.default_rng(3)
    for n in (1, 2, 50, 3000):
        ids = g.integers(0, 5, n).astype("<u4")
        fin = g.random(n) < 0.02
        fin[-1] = True
        reglas, s, _ = repair.comprimir(ids, fin, 9, 2)
        assert (repair.expandir_todo(s, reglas, repair.largos(reglas, 9), 9) == ids).all()
        assert (repair.expandir(s, reglas, 9) == ids).all()


PAGINAS = [(i, f"http://h/{i}", t) for i, t in enumerate(TEXTOS)] + [
    (50, "u", TEXTOS[7]), (51, None, TEXTOS[7]), (51, None, TEXTOS[7]), (None, "n", "only here"), (None, "n", TEXTOS[9]), (60, "a\r\nb", "")]


@pytest.mark.parametrize("minimo", [0, 100])
def test_warc(spark, minimo):
    p = spark.createDataFrame(PAGINAS, "page_id bigint, url string, html string").withColumn("sha1", F.lit("clash"))
    carpeta = f"{carpeta_compartida(spark)}/warc_{uuid.uuid4().hex}"
    indice = warc.escribir(p, carpeta, minimo=minimo)
    leidos = {}
    for rango in (257, 1 << 20):
        leidos[rango] = warc.leer(spark, indice, carpeta, rango=rango).select(
            warc.numero_de("registro").alias("id"), "tipo", "largo", "digest", warc.numero_de("refiere").alias("de"), "payload").collect()
        assert len(leidos[rango]) == len(PAGINAS)
    assert sorted(map(repr, leidos[257])) == sorted(map(repr, leidos[1 << 20]))
    mayor = {}
    for i, _, h in PAGINAS:
        mayor[h or ""] = max(mayor.get(h or "", -1), -1 if i is None else i)
    espera = []
    for h, ids in ((h, [i for i, _, x in PAGINAS if (x or "") == h]) for h in mayor):
        b = h.encode()
        d = base64.b32encode(hashlib.sha1(b).digest()).decode()
        m = None if mayor[h] < 0 else mayor[h]
        primero = True
        for i in sorted(ids, key=lambda x: (x is None, -(x or 0))):
            es = len(b) < minimo or (i == m and primero)
            primero = primero and i != m
            espera.append((i, "response" if es else "revisit", len(b), d, None if es else m, b if es else None))
    assert sorted(map(repr, map(tuple, ((r.id, r.tipo, r.largo, r.digest, r.de, None if r.payload is None else bytes(r.payload))
                                        for r in leidos[257])))) == sorted(map(repr, espera))
    assert warc.leer(spark, warc.escribir(p.limit(0), carpeta), carpeta).count() == 0


def test_warc_magia_falsa():
    """Magic bytes inside a member, broken members and text between members are passed over."""
    import io
    dentro = warc.MAGIA + b"\x00junk" + warc.registro("9:0", "u", "00" * 20, 3, b"abc", None)
    malo = warc.MAGIA + b"\x00" * 30
    z = malo + warc.registro("1:0", "u", "00" * 20, len(dentro), dentro, None, nivel=0) + b"xx" + warc.registro("2:0", "u", "00" * 20, 1, b"z", None)
    for rango in (40, 10_000):
        ids = [c["WARC-Record-ID"] for a in range(0, len(z), rango)
               for c, _ in warc.registros_de(io.BytesIO(z), a, min(len(z), a + rango), len(z))]
        if rango > len(z):
            assert ids == ["<urn:x-page:1:0>", "<urn:x-page:2:0>"]
        assert "<urn:x-page:1:0>" in ids and "<urn:x-page:2:0>" in ids


def test_idioma(spark, docs, vacia, carpeta):
    d = spark.read.parquet(f"{carpeta}/documents.parquet")
    fuera = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    red = idioma.entrenar(idioma.muestra(d.filter(~fuera), runs=1500), vueltas=5)
    m = idioma.predecir(d.filter(fuera), red).filter("fila.lang IS NOT NULL AND fila.n_chars > 60").select(
        (F.col("idioma") == F.col("fila.lang")).alias("bien")).collect()
    assert sum(r.bien for r in m) / len(m) > 0.95
    r = idioma.predecir(docs, red).collect()
    assert len(r) == len(FILAS)
    for x in r:
        letras = any(c.isalpha() for c in x.fila.text or "")
        assert (x.idioma == "und") == (not letras) and 0 <= x.puntos <= 1
        assert letras or x.puntos == 0
    iguales = {x.idioma for x in r if x.fila.text == TEXTOS[7]}
    assert len(iguales) == 1
    assert idioma.predecir(vacia, red).count() == 0 and idioma.muestra(vacia) == []
    assert {x.idioma for x in idioma.predecir(docs, idioma.entrenar([])).collect()} == {"und"}


def test_muestra_lee_runs_enteros(spark):
    """Training counts the same 16-byte pieces that prediction reads, also of scripts without blanks."""
    textos = ["第一条规定了当事人双方的权利和义务以及争议的解决方式", "Donaudampfschifffahrtsgesellschaft x " * 3, "año", "a" * 16, "b" * 17]
    d = spark.createDataFrame([("zz", t) for t in textos], "lang string, text string")
    r = idioma.Runs(pa.array(textos))
    assert {p: n for _, p, n in idioma.muestra(d)} == Counter(r.bytes(i).lower() for i in range(len(r.ini)))


def test_mas_idiomas_que_la_cuota(spark):
    """70 languages: each is a class, the sample keeps its bound, and the stage keeps clean labelled rows."""
    g = random.Random(9)
    silabas = [a + b for a in "bcdfghjklmnpqrstvwxyz" for b in "aeiou"]
    filas = []
    for k in range(70):
        voces = ["".join(g.choice(s) for _ in range(g.randint(2, 4))) for s in [g.sample(silabas, 8)] for _ in range(300)]
        filas += [(100 * k + j, " ".join(g.choice(voces) for _ in range(80)), f"l{k:02d}") for j in range(12 - (k > 64))]
    d = spark.createDataFrame([*filas, (-1, "12 34 !!", None)], "doc_id bigint, text string, lang string")
    todas = idioma.muestra(d)
    assert {i for i, _, _ in todas} == {x for _, _, x in filas}
    pocas = idioma.muestra(d, runs=20, idiomas=7)
    assert {i for i, _, _ in pocas} == {x for _, _, x in filas} and len(pocas) <= 7 * 20
    quedan = {r.doc_id for r in corpus_pipeline.lengua(spark, d, "").collect()}
    assert quedan == {i for i, _, _ in filas}
    assert corpus_pipeline.umbral(4) == corpus_pipeline.umbral(1) == corpus_pipeline.PUNTOS_IDIOMA


def test_gradientes():
    red = idioma.Red(["x", "y", "z"], estado=4)
    red.p = {k: v.astype(np.float64) for k, v in red.p.items()}
    x, _ = idioma.a_bytes([b"hola", b"abc", b"zz"])
    y, w = np.array([0, 1, 2]), np.ones(3)
    _, g = red.gradientes(x, y, w)
    for k, p in red.p.items():
        i = np.unravel_index(np.abs(g[k]).argmax(), g[k].shape)
        p[i] += 1e-4
        a, _ = red.gradientes(x, y, w)
        p[i] -= 2e-4
        b, _ = red.gradientes(x, y, w)
        p[i] += 1e-4
        assert abs((a - b) / 2e-4 - g[k][i]) < 1e-3


def repetidas(w):
    v = [tuple(w[i: i + 8]) for i in range(len(w) - 7)]
    return len({j for i, x in enumerate(v) if v.count(x) > 1 for j in range(i, i + 8)})


def test_reglas(docs, vacia):
    m = reglas.evaluar(docs).collect()
    assert len(m) == len(FILAS)
    for r in m:
        t = r.fila.text or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        lineas = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        assert (r.n_words, r.word_chars, r.n_dup_lines) == (len(w), sum(map(len, w)), len(lineas) - len(set(lineas)))
        assert r.n_symbols == len(re.findall(r"[#*$%&|<>]", t))
        if t != LARGO:
            assert r.n_repeat_words == repetidas(w)
        assert r.base_failed == (len(w) < 20 or 100 * r.n_repeat_words > 30 * len(w))
        assert not (r.kept and r.base_failed)
    assert reglas.evaluar(vacia).count() == 0
    b = reglas.buenos(docs)
    assert b.columns == docs.columns and b.count() > 0


def test_conteo(docs, vacia):
    from tokenizers import Tokenizer, models, pre_tokenizers
    ruta = vocabularios.path("piece_bpe_32k.model")
    for vocab, cae in ((viterbi.vocabulario(ruta), True), ([("<unk>", 0.0), ("a", -1.0), ("b", -1.5), ("ab", -2.5), ("bc", -2.0),
                                                             ("c", -1.0), ("abc", -3.5), ("▁", -0.5), ("▁a", -1.5)], False)):
        lib = Tokenizer(models.Unigram(vocab, 0, cae))
        lib.pre_tokenizer = pre_tokenizers.Metaspace(replacement="▁", prepend_scheme="always", split=True)
        c = viterbi.Contador(vocab)
        for t in [x or "" for x in TEXTOS if x != LARGO] + ["".join(AZAR.choice("abcz \né▁") for _ in range(AZAR.randint(0, 12)))
                                                           for _ in range(500)]:
            assert c.texto(t) == len(lib.encode(t, add_special_tokens=False).ids), t
    n = {(r.fila.doc_id, r.fila.text): r.n_piezas for r in viterbi.contar(docs, ruta).collect()}
    assert n[0, None] == 0 and n[1, ""] == 0 and viterbi.contar(vacia, ruta).count() == 0


@pytest.mark.parametrize("trozo, solape", [(1 << 13, 1 << 9), (300, 40), (8, 1)])
def test_bpe(docs, vacia, trozo, solape):
    import tiktoken
    ruta = vocabularios.path("byte_bpe_50k.tiktoken")
    lib = tiktoken.Encoding("x", pat_str=vocabularios.PATTERN, mergeable_ranks=bpe.leer_rangos(ruta), special_tokens={})
    d = docs if trozo > 100 else docs.filter(F.coalesce(F.length("text"), F.lit(0)) < 5000)
    got = bpe.codificar(d, ruta, vocabularios.PATTERN, trozo=trozo, solape=solape).collect()
    hay = [(r.doc_id, r.text) for r in d.collect()]
    assert sorted((repr(r.doc_id), list(r.ids)) for r in got) == sorted((repr(i), lib.encode_ordinary(t or "")) for i, t in hay)
    if trozo > 300:
        r = bpe.resumir(bpe.codificar(docs, ruta, vocabularios.PATTERN), ruta).collect()
        assert sorted(x.decoded_sha256 for x in r) == sorted(hashlib.sha256((t or "").encode()).hexdigest() for _, t, _ in FILAS)
        assert bpe.resumir(bpe.codificar(vacia, ruta, vocabularios.PATTERN), ruta).count() == 0


@pytest.mark.parametrize("por_tramo", [128, 3])
def test_coser(spark, por_tramo, monkeypatch):
    """Chunks of all sizes, in one task and dealt out; texts in which neighbours share no boundary are encoded whole."""
    monkeypatch.setattr(bpe, "TROZOS_POR_TRAMO", por_tramo)
    ruta = vocabularios.path("byte_bpe_50k.tiktoken")
    c = bpe.codificador(ruta, vocabularios.PATTERN)
    textos = ["a" * 500, " " * 300 + "x", "ab " * 100 + "c" * 200 + " d", "\n \n" * 70, "'s" * 90, "it's we'll o'l " * 40,
              "'re'" * 60, "x  y   z\n\n " * 50, "12 345 6789" * 30, "é世🙂 " * 80] + [prosa(120) for _ in range(3)]
    d = spark.createDataFrame(list(enumerate(textos)), "doc_id bigint, text string")
    for trozo, solape in ((20, 5), (64, 1), (50, 25), (100, 30)):
        espera = {i: c.ids(c.patron.findall(t)).tolist() for i, t in enumerate(textos)}
        r = bpe.codificar(d, ruta, vocabularios.PATTERN, trozo=trozo, solape=solape).collect()
        assert len(r) == len(textos) and {x.doc_id: list(x.ids) for x in r} == espera


def test_trozos_al_alcance(spark):
    """Chunks are no rare case: of the test texts one in twenty-five has several, with almost a quarter of the text."""
    t = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select(F.length("text").alias("n"))
    r = t.agg(F.avg((F.col("n") > bpe.TROZO).cast("double")), F.sum(F.when(F.col("n") > bpe.TROZO, F.col("n"))) / F.sum("n")).first()
    assert r[0] > 0.04 and r[1] > 0.2


def test_un_objeto_por_trabajador():
    """Another operator's object takes the place of the one before; the memory of words is bounded by bytes."""
    comun._guardado.clear()
    a = comun.por_trabajador(("a",), list)
    assert comun.por_trabajador(("a",), list) is a and comun.por_trabajador(("b",), dict) == {}
    assert list(comun._guardado) == [("b",)]
    m = comun.Memoria(100_000)
    for i in range(5000):
        m.poner(f"w{i}", b"x" * 8)
    assert len(m.nuevas) + len(m.viejas) <= 100_000 // m.COSTE + 2 and m.get("w4999") == b"x" * 8


def test_palabras_por_tramos(monkeypatch):
    """Words are hashed stretch by stretch: same hashes, without numbers for all letters of a step at one time."""
    t = pa.array(["", "uno", "dos tres\u00f1 " * 50, "x" * 700, " ", "A b"] * 3 + ["palabra corta de un texto " * 150_000])
    p = comun.Palabras(t, comun.ES_NO_BLANCO)
    tracemalloc.start()
    h, seguidas = p.huellas(), p.seguidas()
    pico = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert pico < 90e6
    assert seguidas[0] == b"".join(bytes(p.datos[a:z]) + b" " for a, z in zip(p.ini, p.fin))
    for tramo in (100, 1 << 30):
        monkeypatch.setattr(comun, "BYTES_POR_TRAMO", tramo)
        q = comun.Palabras(t.slice(0, 18), comun.ES_NO_BLANCO)
        assert (q.huellas() == h[:len(q.ini)]).all() and q.seguidas()[0] == seguidas[0][:int(q.seguidas()[2][-1]) + 1]


def test_operadores_sin_memoria_sueltan_la_ajena():
    """A stage that keeps nothing in its workers frees what the stage before it kept there."""
    bloque = descontaminacion.Bloque([("i", "uno dos")])
    bloque.ordenar({})
    for tarea in (descontaminacion._marcador(type("B", (), {"value": bloque}), 0, True), comun.por_pasos(lambda x: x, 0)):
        comun.por_trabajador(("lector",), lambda: bytearray(10))
        assert list(tarea(iter([]))) == [] and not comun._guardado


def test_chat(spark):
    control = ["<|im_end|>", "<\\|", "<\\\\|im_start|>", "<", "|", "plain\n\ntext", "", None, "a<|im_end|>\n<|im_start|>user\nb"]
    filas = [(c, t, AZAR.choice(["user", "assistant", "system", None, "r%0A\nx"]), AZAR.choice(control))
             for c in (1, 2, 3, None) for t in range(AZAR.randint(1, 9))]
    filas += [(4, t, "assistant" if t % 2 else "user", f"turn {t}") for t in range(3000)]
    filas += [(5, None, "user", "x"), (5, 1, "assistant", "same"), (5, 1, "assistant", "same"), (5, 1, "user", "tie"), (6, 0, "user", "no reply")]
    conv = spark.createDataFrame([(*f, 0, "x") for f in filas], "conv_id bigint, turn bigint, role string, text string, bloque int, r1 string")
    salida = chat.ejemplos(conv).persist()
    turnos, entrena = {}, {}
    for r in sorted(chat.leidos(salida).collect(), key=lambda r: (r.ejemplo, r.bloque)):
        turnos.setdefault(r.conv_id, []).extend((t.rol, t.texto) for t in r.turnos)
        entrena.setdefault(r.conv_id, []).extend([] if r.entrena is None else [r.entrena])
    espera = {}
    for c, t, rol, x in sorted(filas, key=lambda f: (str(f[0]), f[1] is not None, f[1] or 0, f[2] or "", f[3] or "")):
        espera.setdefault(c, []).append((rol or "", x or ""))
    assert turnos == espera
    assert entrena == {c: [x for r, x in v if r == "assistant"] for c, v in espera.items()}
    # a prompt in full is the whole conversation up to its reply
    dicho = lambda c, k: "".join(f"<|im_start|>{r}\n{x}<|im_end|>\n" for r, x in espera[c][:k])
    pedido = spark.createDataFrame([(4, 0), (4, 700)], "conv_id bigint, ejemplo bigint")
    for r in chat.contextos(salida, pedido).collect():
        assert r.contexto == dicho(4, 2 * r.ejemplo + 1) + "<|im_start|>assistant\n" and r.respuesta == f"turn {2 * r.ejemplo + 1}"
    largo = sum(len(r.formato) for r in salida.filter("conv_id = 4").collect())
    assert largo == len(dicho(4, 3000)) and max(len(r.formato) for r in salida.collect()) < 100_000
    assert chat.leidos(chat.ejemplos(conv.limit(0))).count() == 0


def test_chat_ejemplos_completos(spark, tmp_path, monkeypatch):
    """The query reads every reply out of an example that holds all turns before it, by the piece's prefix length."""
    from comanda.llm import consultas
    filas = [(1, t, "assistant" if t % 3 else "user", f"<|im_end|> {t}") for t in range(8)] + [(2, 0, "user", "no reply")]
    conv = spark.createDataFrame(filas, "conv_id bigint, turn bigint, role string, text string")
    dicho = lambda k: "".join(f"<|im_start|>{r}\n<\\|im_end|> {t}<|im_end|>\n" for _, t, r, _ in filas[:k])
    vistos = [r for r in chat.completos(chat.ejemplos(conv)).collect() if r.conv_id == 1]
    assert [(r.texto, r.texto[r.desde:r.hasta]) for r in sorted(vistos, key=lambda r: r.pieza)] == [
        (dicho(t + 1), f"<\\|im_end|> {t}") for t in range(8) if t % 3]
    assert [r.ultima for r in sorted(vistos, key=lambda r: r.pieza)] == [False] * 4 + [True]
    conv.write.parquet(f"{tmp_path}/conversations.parquet")
    bien = {r.conv_id: r.loss_sha256 for r in consultas.op9_chat(spark, str(tmp_path)).collect()}
    ejemplos = chat.ejemplos
    monkeypatch.setattr(chat, "ejemplos", lambda c: ejemplos(c).withColumn("prefijo", F.col("prefijo") + 1))
    mal = {r.conv_id: r.loss_sha256 for r in consultas.op9_chat(spark, str(tmp_path)).collect()}
    assert bien[1] != mal[1] and bien[2] == mal[2]


def huella(t, k=3):
    w = re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode().lower())
    if not w:
        return 0
    s = [b" ".join(w[i: i + k]) for i in range(max(1, len(w) - k + 1))]
    h = [xxhash.xxh64_intdigest(x, 42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def clases(f, distancia=3):
    padre = list(range(len(f)))

    def raiz(i):
        while padre[i] != i:
            i = padre[i]
        return i
    for i in range(len(f)):
        for j in range(i):
            if bin(f[i] ^ f[j]).count("1") <= distancia:
                padre[raiz(i)] = raiz(j)
    return [raiz(i) for i in range(len(f))]


def test_simhash(docs, vacia):
    f = [huella(t) for _, t, _ in FILAS]
    c = clases(f)
    menor = {x: min((i for (i, _, _), y in zip(FILAS, c) if y == x and i is not None), default=None) for x in c}
    espera = sorted(repr((i, h, menor[x])) for (i, _, _), h, x in zip(FILAS, f, c))
    got = simhash.grupos(docs).collect()
    assert sorted(repr((r.id, r.huella & (1 << 64) - 1, r.grupo)) for r in got) == espera
    assert simhash.grupos(vacia).count() == 0
    uno = simhash.uno_por_grupo(docs)
    quedan = [i for (i, _, _), x in zip(FILAS, c) if i is not None and menor[x] == i]
    assert uno.columns == docs.columns
    assert sorted(r.doc_id for r in uno.collect() if r.doc_id is not None) == sorted(set(quedan))


def test_uno_por_grupo_por_fila(spark):
    """Ids on several texts, a copy under a larger id, and copies without an id."""
    g = random.Random(4)
    a, b, c, d = (" ".join(f"{x}{g.randrange(10**6)}" for _ in range(60)) for x in "abcd")
    filas = [(1, a, "p"), (1, b, "q"), (2, b, "r"), (2, c, "s"), (0, a, "t"), (None, d, "u"), (None, d, "u"), (None, c, "v"),
             (None, d, "w"), (5, "", "x"), (5, "", "x")]
    uno = simhash.uno_por_grupo(spark.createDataFrame(filas, "doc_id bigint, text string, extra string").repartition(3)).collect()
    # each text once, at its smallest id; before, b or c was lost with the other row of its id and d stood three times
    assert sorted(r.text for r in uno) == sorted([a, b, c, d, ""])
    assert {r.text: r.doc_id for r in uno} == {a: 0, b: 1, c: 2, d: None, "": 5}


@pytest.mark.parametrize("tope", [2, 64])
def test_enlaces(spark, tope):
    """A dense ball of fingerprints, whose signatures are cut again and again, against all pairs."""
    from comanda.plans.durable import Corte
    g = random.Random(2)
    centro = g.getrandbits(64)
    f = {g.getrandbits(64) for _ in range(300)}
    for _ in range(500):
        x = centro
        for _ in range(g.randint(0, 4)):
            x ^= 1 << g.randrange(64)
        f.add(x)
    f = sorted(f)
    con_signo = lambda x: x - (1 << 64) if x >> 63 else x
    u = spark.createDataFrame([(con_signo(x),) for x in f], "huella bigint")
    got = {frozenset((r.src, r.dst)) for r in simhash.enlaces(u, Corte(spark, "prueba"), tope=tope).collect()}
    a = np.array(f, np.uint64)
    i, j = np.nonzero(np.triu(np.bitwise_count(a[:, None] ^ a[None, :]) <= 3, 1))
    assert got == {frozenset((con_signo(f[x]), con_signo(f[y]))) for x, y in zip(i, j)}


@pytest.mark.parametrize("nombre", list(oraculo.oraculo()))
def test_sql(spark, carpeta, nombre):
    from comanda.llm.consultas import consultas
    from verificar import _filas
    con = duckdb.connect()
    for t in ("documents", "benchmark", "conversations", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{carpeta}/{t}.parquet')")
    a, b = consultas()[nombre](spark, carpeta).toArrow(), con.sql(oraculo.oraculo()[nombre]).to_arrow_table()
    assert sorted(a.column_names) == sorted(b.column_names) and _filas(a) == _filas(b)


@pytest.mark.parametrize("nombre, etapa", corpus_pipeline.STAGES)
def test_etapas(spark, docs, vacia, carpeta, nombre, etapa):
    """Awkward rows and an empty table go through every stage."""
    salida = etapa(spark, docs, carpeta)
    filas = salida.collect()
    assert len(filas) <= len(FILAS) and etapa(spark, vacia, carpeta).count() == 0
    if nombre != "ids":
        assert salida.columns == docs.columns
        dadas = {repr(r) for r in docs.collect()}
        assert {repr(r) for r in filas} <= dadas


def test_ids_de_a_uno(spark, docs, carpeta):
    """The last stage never has two Python operators in one job: the second worker of a task would hold its memory on."""
    plan = corpus_pipeline.ids(spark, docs, carpeta)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1


def test_corpus(spark, carpeta):
    """The stages one after the other against each one's brute force on its own input."""
    d = spark.read.parquet(f"{carpeta}/documents.parquet")
    banco = [tuple(r) for r in spark.read.parquet(f"{carpeta}/benchmark.parquet").select("item_id", "text").collect()]
    antes, pasos = d, {}
    for nombre, etapa in corpus_pipeline.STAGES[:-1]:
        antes = spark.createDataFrame(etapa(spark, antes, carpeta).collect(), d.schema)
        pasos[nombre] = {r.doc_id: r.text for r in antes.collect()}
    assert pasos["lengua"].keys() <= pasos["calidad"].keys()
    ids = sorted(pasos["lengua"])
    f = [huella(pasos["lengua"][i]) for i in ids]
    c = clases(f)
    assert pasos["sin_copias"].keys() == {min(i for i, y in zip(ids, c) if y == x) for x in c}
    assert pasos["sin_pruebas"].keys() == {i for i, t in pasos["sin_copias"].items() if not contaminacion(t, banco)[3]}
    fin = corpus_pipeline.run(spark, carpeta).collect()
    assert {r.doc_id: r.decoded_sha256 for r in fin} == {
        i: hashlib.sha256((t or "").encode()).hexdigest() for i, t in pasos["sin_pruebas"].items()}
