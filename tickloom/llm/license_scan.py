"""License scan: normalised text compared to license templates by the Dice coefficient over word bigrams.

Everything is a Spark SQL expression of one row: no Python, no join and no shuffle. A text is lower-cased, `licence` read as
`license`, and everything but a-z and 0-9 becomes a single space. Every window (run of words, across lines and
paragraphs) of the text is compared; its set is its distinct bigrams. A window matches a template when
2 |A and B| / (|A| + |B|) >= `least`, and the best window of each template counts.

The best window is found without trying all: a bigram of the template next to a window never lowers its coefficient when
taken in, nor does another bigram at its edge when left out. So it begins where a run of bigrams of the template begins
and ends where one ends. Windows of several runs have up to (2 - least) / least times the template's bigrams, repeated
ones counted, and at least the bigrams in common that a match has. Templates of which the whole text has too few are passed by.
Since a match shares most bigrams of a template, every match also contains one of a few key words (`key_words` finds a
set that provably hits every match); texts without one are passed by.

Defined results: null and empty texts, and texts of one word, match nothing (license null, dice 0.0, n_licenses 0); ties
between templates go to the lesser name; every row of the table gives a row; other columns stay out.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Public license texts, or the notices by which works name their license.
TEMPLATES: dict[str, list[str]] = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.',
    ],
    "MIT": [
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.',
    ],
    "ISC": [
        "Licensed under the ISC License.",
        'Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.',
    ],
    "0BSD": ['Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.'],
    "MIT-0": ['Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.'],
    "BSD-2-Clause": [
        "Licensed under the BSD 2-Clause License.",
        'Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.',
    ],
    "BSD-3-Clause": [
        "Licensed under the BSD 3-Clause License.",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        'Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.',
    ],
    "BSD-4-Clause": [
        'Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. 3. All advertising materials mentioning features or use of this software must display the following acknowledgement: This product includes software developed by the organization. 4. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.',
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details. You should have received a copy of the GNU General Public License along with this program. If not, see https://www.gnu.org/licenses/.",
    ],
    "GPL-2.0": ["This work is licensed under the GNU General Public License, version 2."],
    "LGPL-3.0": ["This work is licensed under the GNU Lesser General Public License, version 3."],
    "LGPL-2.1": ["Licensed under the GNU Lesser General Public License, version 2.1."],
    "LGPL-2.0": ["Licensed under the GNU Library General Public License, version 2."],
    "AGPL-3.0": ["This work is licensed under the GNU Affero General Public License, version 3."],
    "MPL-2.0": ["Licensed under the Mozilla Public License, Version 2.0.", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."],
    "BSL-1.0": ["Distributed under the Boost Software License, Version 1.0."],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "CC-BY-ND-4.0": ["Licensed under CC BY-ND 4.0.", "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License."],
    "CC-BY-NC-SA-4.0": ["Licensed under CC BY-NC-SA 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License."],
    "CC-BY-NC-ND-4.0": ["Licensed under CC BY-NC-ND 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License."],
    "CC0-1.0": ["Released under CC0 1.0 Universal.", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."],
    "Unlicense": ["This is free and unencumbered software released into the public domain."],
    "Zlib": [
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:",
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice may not be removed or altered from any source distribution.",
    ],
}
LEAST = 0.8
#: From how many characters on a text is looked at for the key words of full texts.
LONG = 2000


def gnu_notices(adjective: str, version: str) -> list[str]:
    """The notices by which works name a GNU license: of a version or later ones, or of one version only."""
    out, name = [], f"GNU {adjective}General Public License"
    warranty = f"{{noun}} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the {name} for more details."
    for noun in ("program", "library") if adjective in ("Lesser ", "Library ") else ("program",):
        for terms in (f"{name} as published by the Free Software Foundation, either version {version} of the License, or (at your option) any later version.", f"{name} version {version} as published by the Free Software Foundation."):
            granted = f"This {noun} is free software: you can redistribute it and/or modify it under the terms of the {terms}"
            copy = f"You should have received a copy of the {name} along with this {noun}"
            out += [f"{granted} This {warranty.format(noun=noun)} {copy}{end}" for end in (". If not, see https://www.gnu.org/licenses/.", "; if not, write to the Free Software Foundation, Inc., 51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA.")]
            out.append(granted)
    return out


GNU = {"GPL-2.0": ("", "2"), "GPL-3.0": ("", "3"), "LGPL-2.0": ("Library ", "2"), "LGPL-2.1": ("Lesser ", "2.1"), "LGPL-3.0": ("Lesser ", "3"), "AGPL-3.0": ("Affero ", "3")}
for _name, _kind in GNU.items():
    TEMPLATES[_name] += [t for t in gnu_notices(*_kind) if t not in TEMPLATES[_name]]
#: The full texts, of Creative Commons only CC0: one of that family alone would give its name to the others.
for _path in sorted(Path(__file__).with_name("licenses").glob("*.txt")):
    TEMPLATES[_path.stem] += [_path.read_text(encoding="utf-8")]


def words_of(text: str) -> list[str]:
    return re.sub(r"[^a-z0-9]+", " ", text.lower().replace("licence", "license")).split()


def bigrams_of(text: str) -> list[str]:
    w = words_of(text)
    return sorted({f"{a} {b}" for a, b in zip(w, w[1:])})  # noqa: B905


def size_bounds(n: int, least: float) -> tuple[int, int]:
    """How many bigrams a set has at least and at most that can match one of n."""
    return math.ceil(n * least / (2 - least) - 1e-9), math.floor(n * (2 - least) / least + 1e-9)


def key_words(templates: dict[str, list[str]], least: float) -> list[str]:
    """Words of which every match of any template contains one.

    A match shares at least `low` bigrams of its template; it contains one of any n - low + 1 of them. So words are
    enough that lie in so many bigrams of each template; they are chosen greedily, the longest first among equals.
    """
    sets = [bigrams_of(t) for texts in templates.values() for t in texts]
    need = {k: len(s) - size_bounds(len(s), least)[0] + 1 for k, s in enumerate(sets)}
    left, out = {k: set(s) for k, s in enumerate(sets)}, []
    while need:
        gain: dict[str, int] = {}
        for k in need:
            for w, n in Counter(w for g in left[k] for w in set(g.split())).items():
                gain[w] = gain.get(w, 0) + min(need[k], n)
        word = max(gain, key=lambda w: (gain[w] * max(0.01, len(w) - 3) ** 2, w))  # common words are short
        out.append(word)
        for k in list(need):
            hit = {g for g in left[k] if word in g.split()}
            left[k] -= hit
            need[k] -= len(hit)
            if need[k] <= 0:
                del need[k]
    return [w for w in out if not any(v != w and v in w for v in out)]


def has_any(text: Column, words: list[str]) -> Column:
    found = F.lit(False)
    for w in words:
        found = found | F.contains(text, F.lit(w))
    return found


def least_chars(text: str, least: float) -> int:
    """Characters that a text has at least with a window that matches: those of the shortest second words of its bigrams."""
    grams = bigrams_of(text)
    return sum(sorted(len(g) - g.index(" ") for g in grams)[: size_bounds(len(grams), least)[0]])


def may_match(plain: Column, templates: dict[str, list[str]], least: float) -> Column:
    """Whether a text has a key word; those of long templates count only in texts that are long enough to match one."""
    long = {name: [t for t in texts if least_chars(t, least) >= LONG] for name, texts in templates.items()}
    short = {name: [t for t in texts if least_chars(t, least) < LONG] for name, texts in templates.items()}
    return has_any(plain, key_words(short, least)) | ((F.length(plain) >= F.lit(LONG)) & has_any(plain, key_words(long, least)))


def strings(values: list[str]) -> Column:
    """A constant array; one literal is sent in place of thousands."""
    return F.split(F.lit("|".join(values)), "[|]")


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with value computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def template_literal(templates: dict[str, list[str]], least: float) -> Column:
    rows = []
    for name, texts in sorted(templates.items()):
        for text in texts:
            grams = bigrams_of(text)
            low, span = size_bounds(len(grams), least)[0], size_bounds(len(words_of(text)) - 1, least)[1]
            rows.append(F.struct(F.lit(name).alias("name"), F.lit(low).alias("low"), F.lit(span).alias("span"), strings(grams).alias("grams")))
    return F.array(*rows)


def best_window(grams: Column, template: Column, own: Column) -> Column:
    """The greatest Dice coefficient of a window of grams with a template; own: the template's bigrams that grams has."""

    def of_hits(hits: Column) -> Column:
        marks = F.transform(hits, lambda p, k: F.struct(p.alias("p"), k.alias("k")))
        starts = F.filter(marks, lambda m: F.coalesce(F.get(hits, m["k"] - 1) < m["p"] - 1, F.lit(True)))
        ends = F.filter(marks, lambda m: F.coalesce(F.get(hits, m["k"] + 1) > m["p"] + 1, F.lit(True)))
        return let(ends, lambda ends: F.array_max(F.transform(starts, lambda s, i: from_start(s, F.slice(ends, i + 1, F.floor(template["span"] / 2).cast("int") + 1)))))

    def from_start(s: Column, ends: Column) -> Column:
        one_run = lambda e: e["k"] - s["k"] == e["p"] - s["p"]
        some = F.filter(ends, lambda e: (e["k"] - s["k"] + 1 >= template["low"]) & ((e["p"] - s["p"] < template["span"]) | one_run(e)))
        return F.array_max(F.transform(some, lambda e: let(F.array_distinct(F.slice(grams, s["p"], e["p"] - s["p"] + 1)), dice)))

    def dice(a: Column) -> Column:
        return F.size(F.array_intersect(a, own)) * F.lit(2.0) / (F.size(a) + F.size(template["grams"]))

    return let(F.filter(F.transform(grams, lambda g, k: F.when(F.array_contains(own, g), k + 1)), lambda p: p.isNotNull()), of_hits)


def findings(text: Column, templates: dict[str, list[str]], least: float) -> Column:
    """An array of (neg, name), neg being minus the Dice coefficient, for each template that a window of the text matches, the best first."""
    known = template_literal(templates, least)
    every = strings(sorted({g for texts in templates.values() for t in texts for g in bigrams_of(t)}))
    plain = F.replace(F.lower(text), F.lit("licence"), F.lit("license"))
    words = F.split(F.trim(F.regexp_replace(plain, "[^a-z0-9]+", " ")), " ")
    pairs = let(words, lambda w: F.zip_with(F.slice(w, 1, F.size(w) - 1), F.slice(w, 2, F.size(w) - 1), lambda a, b: F.concat(a, F.lit(" "), b)))

    def against(grams: Column, shared: Column) -> Column:
        near = F.filter(known, lambda t: F.size(shared) >= t["low"])
        near = F.transform(near, lambda t: F.struct(t.alias("t"), F.array_intersect(shared, t["grams"]).alias("own")))
        near = F.filter(near, lambda n: F.size(n["own"]) >= n["t"]["low"])
        each = F.transform(near, lambda n: F.struct((-best_window(grams, n["t"], n["own"])).alias("neg"), n["t"]["name"].alias("name")))
        return F.array_sort(F.filter(each, lambda m: m["neg"] <= F.lit(-least)))

    found = let(pairs, lambda grams: let(F.array_intersect(grams, every), lambda shared: against(grams, shared)))
    return F.when(may_match(plain, templates, least), found)


def license_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: dict[str, list[str]] | None = None, least: float = LEAST) -> DataFrame:
    """doc_id, license (the best match), dice, n_licenses (different names matched) of every row."""
    found = docs.select(F.col(id_col).alias("doc_id"), findings(F.col(text_col).cast("string"), templates or TEMPLATES, least).alias("found"))
    best = F.get("found", F.lit(0))
    return found.select("doc_id", best["name"].alias("license"), F.round(F.coalesce(-best["neg"], F.lit(0.0)), 6).alias("dice"), F.coalesce(F.size(F.array_distinct(F.transform("found", lambda m: m["name"]))), F.lit(0)).cast("long").alias("n_licenses"))


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def oracle_sql(templates: dict[str, list[str]] | None = None, least: float = LEAST) -> str:
    """The same scan for DuckDB, without the key words: every unit of fitting size against every template."""
    rows = ", ".join(f"({quoted(name)}, [{', '.join(map(quoted, bigrams_of(t)))}])" for name, texts in sorted((templates or TEMPLATES).items()) for t in texts)
    longest = max(size_bounds(len(bigrams_of(t)), least)[1] for texts in (templates or TEMPLATES).values() for t in texts)
    return f"""
WITH t(name, grams) AS (VALUES {rows}),
plain AS (SELECT doc_id, row_number() OVER () AS r, replace(lower(text), 'licence', 'license') AS x FROM documents),
units AS (SELECT r, unnest(list_distinct(list_concat(string_split(x, chr(10)), string_split_regex(x, '\\n[ \\t\\r]*\\n'), [x]))) AS u FROM plain WHERE x IS NOT NULL),
w AS (SELECT row_number() OVER () AS k, r, string_split(trim(regexp_replace(u, '[^a-z0-9]+', ' ', 'g')), ' ') AS w FROM units),
g AS (SELECT k, r, list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS grams FROM w WHERE len(w) > 1),
m AS (SELECT g.r, t.name, 2.0 * len(list_intersect(g.grams, t.grams)) / (len(g.grams) + len(t.grams)) AS dice
      FROM g JOIN t ON len(g.grams) <= {longest} AND len(g.grams) >= ceil(len(t.grams) * {least} / (2 - {least}) - 1e-9) AND len(g.grams) <= floor(len(t.grams) * (2 - {least}) / {least} + 1e-9)),
b AS (SELECT r, first(name ORDER BY dice DESC, name) AS license, max(dice) AS dice, count(DISTINCT name) AS n FROM m WHERE dice >= {least} GROUP BY r)
SELECT plain.doc_id, b.license, round(coalesce(b.dice, 0.0), 6) AS dice, coalesce(b.n, 0) AS n_licenses FROM plain LEFT JOIN b USING (r)"""
