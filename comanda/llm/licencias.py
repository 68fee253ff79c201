"""License scan: phrases, and license templates compiled to token automata.

Template markup: ``<<beginOptional>>`` ... ``<<endOptional>>`` may be left out, ``<<var;match="...">>`` is a
replaceable region.  Its match is a word range ``.{a,b}`` (that many words of any kind) or alternatives
``x|y`` (one of these words).  All other words are mandatory and must stand as written, in order.
"""

from __future__ import annotations

import re
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, DoubleType, LongType, StringType, StructField, StructType

from comanda.llm.comun import ES_PALABRA, Palabras, como_fila, por_pasos, textos

# fixed values: phrases and their labels
FRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# fixed values: public license texts and notices with their optional and replaceable regions
PLANTILLAS = {
    "mit-text": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
        associated documentation files (the "Software"), to deal in the Software without restriction, including
        without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies
        of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following
        conditions: The above copyright notice and this permission notice <<beginOptional>>(including the next
        paragraph)<<endOptional>> shall be included in all copies or substantial portions of the Software. THE
        SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO
        THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL
        <<var;match=".{1,20}">> BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT,
        TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
        SOFTWARE.""",
    "isc-text": """Permission to use, copy, modify, and<<beginOptional>>/or<<endOptional>> distribute this software for
        any purpose with or without fee is hereby granted, provided that the above copyright notice and this
        permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND <<var;match=".{1,20}">> DISCLAIMS
        ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN
        NO EVENT SHALL <<var;match=".{1,20}">> BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR
        ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT,
        NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS
        SOFTWARE.""",
    "bsd-conditions": """Redistribution and use in source and binary forms, with or without modification, are permitted
        provided that the following conditions are met: <<beginOptional>>1.<<endOptional>> Redistributions of source
        code must retain the above copyright notice, this list of conditions and the following disclaimer.
        <<beginOptional>>2.<<endOptional>> Redistributions in binary form must reproduce the above copyright notice,
        this list of conditions and the following disclaimer in the documentation and/or other materials provided with
        the distribution. <<beginOptional>><<beginOptional>>3.<<endOptional>> Neither the name of
        <<var;match=".{1,20}">> nor the names of its contributors may be used to endorse or promote products derived
        from this software without specific prior written permission.<<endOptional>> THIS SOFTWARE IS PROVIDED BY
        <<var;match=".{1,20}">> "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
        IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL
        <<var;match=".{1,20}">> BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL
        DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR
        PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT
        LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN
        IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""",
    "apache-2.0-header": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file
        except in compliance with the License. You may obtain a copy of the License at <<var;match=".{1,12}">> Unless
        required by applicable law or agreed to in writing, software distributed under the License is distributed on
        an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for
        the specific language governing permissions and limitations under the License.""",
    "apache-2.0-notice": "licensed under the Apache License<<beginOptional>>, Version<<endOptional>> 2.0",
    "gpl-header": """<<var;match="this|the">> <<var;match="program|library|software|file">> is free software; you can
        redistribute it and/or modify it under the terms of the GNU
        <<beginOptional>><<var;match="lesser|library|affero">><<endOptional>> General Public License as published by
        the Free Software Foundation<<beginOptional>>, either<<endOptional>> version <<var;match=".{1,2}">>
        <<beginOptional>>of the License<<endOptional>><<beginOptional>>, or (at your option) any later
        version<<endOptional>>. <<var;match="this|the">> <<var;match="program|library|software|file">> is distributed
        in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of
        MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU
        <<beginOptional>><<var;match="lesser|library|affero">><<endOptional>> General Public License for more details.
        You should have received a copy of the GNU
        <<beginOptional>><<var;match="lesser|library|affero">><<endOptional>> General Public License along with
        <<var;match="this|the">> <<var;match="program|library|software|file">>; if not, <<var;match="see|write">>
        <<var;match=".{1,20}">>""",
    "gpl-notice": """<<var;match="licensed|released|distributed">> under the <<beginOptional>>terms of
        the<<endOptional>> GNU <<beginOptional>><<var;match="lesser|affero">><<endOptional>> General Public License""",
    "mit-notice": """<<var;match="licensed|released|distributed">> under the <<beginOptional>>terms of
        the<<endOptional>> MIT License""",
    "cc-notice": """licensed under <<beginOptional>><<var;match="a|the">><<endOptional>> Creative Commons
        <<var;match=".{1,8}">> License""",
    "public-domain": """This is free and unencumbered software released into the public domain. Anyone is free to copy,
        modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled
        binary, for any purpose, commercial or non-commercial, and by any means. In jurisdictions that recognize
        copyright laws, the author or authors of this software dedicate any and all copyright interest in the software
        to the public domain. We make this dedication for the benefit of the public at large and to the detriment of
        our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all
        present and future rights to this software under copyright law. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT
        WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
        FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL <<var;match=".{1,20}">> BE LIABLE FOR
        ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF
        OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
}

_MARCA = re.compile(r'<<beginOptional>>|<<endOptional>>|<<var;match="([^"]*)">>|[^<]+')
_PALABRA = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def _palabras(texto: str) -> list[bytes]:
    return _PALABRA.findall(texto.encode().lower())


def piezas(plantilla: str) -> list[tuple]:
    """The template as a flat list: ('palabras', set), ('libre', a, b), ('abre',), ('cierra',)."""
    salida: list[tuple] = []
    for m in _MARCA.finditer(plantilla):
        if m[0] == "<<beginOptional>>":
            salida.append(("abre",))
        elif m[0] == "<<endOptional>>":
            salida.append(("cierra",))
        elif m[1] is not None:
            rango = re.fullmatch(r"\.\{(\d+),(\d+)\}", m[1])
            salida.append(("libre", int(rango[1]), int(rango[2])) if rango
                          else ("palabras", frozenset(_palabras(m[1].replace("|", " ")))))
        else:
            salida += [("palabras", frozenset([w])) for w in _palabras(m[0])]
    return salida


class Automata:
    """All templates as one bit-parallel token automaton.

    A bit is a place before a word of some template; reading a word moves the bits that accept it one
    place on, and ``saltos`` closes over the regions that may be left out.  The bits are as many as the
    templates have words, so the state has a fixed size, and texts of any length are read word by word.
    """

    def __init__(self, plantillas: dict[str, str]):
        self.lee: dict[bytes, int] = {}
        self.libre = self.inicio = self.final = 0
        self.nombre: dict[int, str] = {}
        self.saltos: dict[int, int] = {}
        self.anclas: set[bytes] = set()
        n = 0
        for nombre, texto in plantillas.items():
            base, abiertos, salto, obligadas = n, [], [], []
            for pieza in piezas(texto):
                if pieza[0] == "abre":
                    abiertos.append(n)
                elif pieza[0] == "cierra":
                    salto.append((abiertos.pop(), n))
                elif pieza[0] == "libre":
                    for k in range(pieza[2]):
                        self.libre |= 1 << n
                        if k >= pieza[1]:
                            salto.append((n, n - k + pieza[2]))
                        n += 1
                else:
                    for w in pieza[1]:
                        self.lee[w] = self.lee.get(w, 0) | 1 << n
                    if not abiertos and len(pieza[1]) == 1:
                        obligadas += pieza[1]
                    n += 1
            # from back to front each skip already knows where the later ones lead
            for a, b in sorted(salto, reverse=True):
                self.saltos[a] = self.saltos.get(a, 0) | 1 << b | self.saltos.get(b, 0)
            self.inicio |= 1 << base | self.saltos.get(base, 0)
            self.final |= 1 << n
            self.nombre[n] = nombre
            self.anclas.add(max(obligadas, key=lambda w: (len(w), w)))
            n += 1
        self.salta = sum(1 << a for a in self.saltos)
        self.primeras = {w for w, m in self.lee.items() if m & self.inicio}

    def aceptadas(self, palabras: list[bytes]) -> set[str]:
        """Names of the templates that some stretch of the words matches."""
        vistas = estado = 0
        for w in palabras:
            if not estado and w not in self.primeras:
                continue
            estado = ((estado | self.inicio) & (self.lee.get(w, 0) | self.libre)) << 1
            pendiente = estado & self.salta
            while pendiente:
                bit = pendiente & -pendiente
                estado |= self.saltos[bit.bit_length() - 1]
                pendiente ^= bit
            if estado & self.final:
                vistas |= estado & self.final
                estado &= ~self.final
        return {nombre for bit, nombre in self.nombre.items() if vistas >> bit & 1}

    @cached_property
    def huellas(self) -> np.ndarray:
        """Hashes of the words without which neither a template nor a phrase can match."""
        palabras = self.anclas | {f.split()[-1].encode() for f in FRASES}
        return np.sort(Palabras(pa.array([w.decode() for w in sorted(palabras)]), ES_PALABRA).huellas())


def frases(palabras: list[bytes]) -> list[tuple[int, str]]:
    """(first word, label) of every place where a phrase stands."""
    salida = []
    for frase, etiqueta in FRASES.items():
        partes = frase.encode().split()
        ultima = len(partes) - 1
        salida += [(i - ultima, etiqueta) for i, w in enumerate(palabras)
                   if w == partes[-1] and i >= ultima and palabras[i - ultima: i + 1] == partes]
    return salida


def examinar(docs: DataFrame, texto: str = "text", plantillas: dict[str, str] | None = None) -> DataFrame:
    """``fila`` (the input row), ``n_palabras``, ``lugares`` (first words of phrases), ``base`` and ``etiquetas``
    (distinct, sorted), ``puntos``: 1 if a template matches, 0.5 if only a phrase stands, else 0.

    Row by row, without a shuffle.  Null or empty text has no words and no label; repeated rows are rows
    like others.  Only texts with an anchor word (the longest mandatory word of each template, the last of
    each phrase) are read by the automaton; the test is necessary, so it loses nothing.
    """
    campo = docs.columns.index(texto)
    automata = Automata(PLANTILLAS if plantillas is None else plantillas)
    cadenas = ArrayType(StringType())
    tipo = StructType([StructField("fila", docs.schema, False), StructField("n_palabras", LongType()),
                       StructField("lugares", ArrayType(LongType())), StructField("base", cadenas),
                       StructField("etiquetas", cadenas), StructField("puntos", DoubleType())])

    def paso(lote: pa.RecordBatch) -> pa.RecordBatch:
        p = Palabras(textos(lote, campo), ES_PALABRA)
        n = lote.num_rows
        lugares: list[list] = [[] for _ in range(n)]
        base: list[list] = [[] for _ in range(n)]
        todas: list[list] = [[] for _ in range(n)]
        puntos = np.zeros(n)
        h, ancla = p.huellas(), automata.huellas
        toca = ancla[np.minimum(np.searchsorted(ancla, h), len(ancla) - 1)] == h
        for d in np.unique(p.doc[toca]).tolist():
            a, z = int(p.primera[d]), int(p.primera[d] + p.n[d]) - 1
            palabras = _PALABRA.findall(p.datos[p.ini[a]: p.fin[z]].tobytes())
            dadas = frases(palabras)
            lugares[d] = sorted(i for i, _ in dadas)
            base[d] = sorted({e for _, e in dadas})
            propias = automata.aceptadas(palabras)
            todas[d] = sorted(propias | set(base[d]))
            puntos[d] = 1.0 if propias else 0.5 if dadas else 0.0
        cadena = pa.list_(pa.string())
        return pa.RecordBatch.from_arrays(
            [lote.column(0), pa.array(p.n), pa.array(lugares, pa.list_(pa.int64())), pa.array(base, cadena),
             pa.array(todas, cadena), pa.array(puntos)],
            ["fila", "n_palabras", "lugares", "base", "etiquetas", "puntos"])

    return como_fila(docs).mapInArrow(por_pasos(paso, campo), tipo)


def expresion(plantilla: str) -> str:
    """The template as a regular expression over words that a blank follows each, for checks."""
    partes: list[str] = []
    for pieza in piezas(plantilla):
        if pieza[0] == "abre":
            partes.append("(?:")
        elif pieza[0] == "cierra":
            partes.append(")?")
        elif pieza[0] == "libre":
            partes.append("(?:[^ ]+ ){%d,%d}" % pieza[1:])
        else:
            partes.append("(?:" + "|".join(sorted(w.decode() for w in pieza[1])) + ") ")
    return " " + "".join(partes)
