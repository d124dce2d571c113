"""License scans by template-markup matching.

A template is a license's whole wording with marks: ``<<beginOptional>> ...
<<endOptional>>`` around words that may be left out, ``<<var;words=a-b>>`` for a to b
words of any kind, ``<<alt;this|that>>`` for wording that may stand in place of each
other.  It is compiled into an automaton over words, which is run from each place
where words stand that it can begin with.  A text carries the template's label
if the automaton accepts from some place: every mandatory word is there, in order,
with nothing else between.  Base phrases are found beside it, word by word.

Words are runs of letters, digits and non-ASCII characters, A-Z lower-cased.  Null
and empty texts have no words, no labels and score 0.  Repeated rows get equal
results.  Very long texts are scanned whole.  Other columns may have any names.
An empty table gives no rows.
"""

from __future__ import annotations

import functools
import re
from dataclasses import dataclass, replace

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, text_of

#: Phrases and their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

_OPEN, _CLOSE = "<<beginOptional>>", "<<endOptional>>"


def _may(words: str) -> str:
    return f"{_OPEN}{words} {_CLOSE}"


_UNDER = "<<alt;licensed|released|distributed|available>> under "
_COPYRIGHT = _may("Copyright <<var;words=1-12>>") + _may("All rights reserved.")

#: The wording of licenses and of the notices that name them.
_BSD = f"""{_COPYRIGHT} Redistribution and use in source and binary forms, with or without modification, are permitted
provided that the following conditions are met: {_may("1.")} Redistributions of source code must retain the above copyright
notice, this list of conditions and the following disclaimer. {_may("2.")} Redistributions in binary form must reproduce the
above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials
provided with the distribution."""
_BSD_NAMES = f"""{_may("3.")} Neither the name of <<var;words=1-12>> nor the names of its contributors may be used to endorse
or promote products derived from this software without specific prior written permission."""
_BSD_END = """THIS SOFTWARE IS PROVIDED BY <<var;words=1-8>> "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED
TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL
<<var;words=1-8>> BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT
NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER
CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE)
ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
_GPL_END = """This <<alt;program|library|file>> is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without
even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more
details."""
_GPL = """is free software: you can redistribute it and/or modify it under the terms of the GNU
General Public License as published by the Free Software Foundation"""
TEMPLATES: dict[str, str] = {
    "apache-2.0-header": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use <<alt;this file|this software>> except
in compliance with the License. You may obtain a copy of the License at <<alt;http|https>>://www.apache.org/licenses/LICENSE-2.0
Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS"
BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language
governing permissions and limitations under the License.""",
    "apache-2.0": f"{_UNDER}the Apache License{_OPEN}, Version{_CLOSE} 2.0",
    "bsd-2-clause": f"{_BSD} {_BSD_END}",
    "bsd-3-clause": f"{_BSD} {_BSD_NAMES} {_BSD_END}",
    "bsd-notice": f"{_UNDER}{_may('the')}{_may('terms of the')}<<alt;BSD|2-clause BSD|3-clause BSD|BSD 2-clause|BSD 3-clause>> License",
    "cc-by-4.0": f"{_UNDER}{_may('a')}{_may('the')}<<alt;CC BY|Creative Commons Attribution>> 4.0 {_may('International')}{_may('License')}",
    "cc-by-nc-4.0": f"{_UNDER}{_may('a')}{_may('the')}<<alt;CC BY-NC|Creative Commons Attribution-NonCommercial>> 4.0 {_may('International')}{_may('License')}",
    "cc-by-sa-4.0": f"{_UNDER}{_may('a')}{_may('the')}<<alt;CC BY-SA|Creative Commons Attribution-ShareAlike>> 4.0 {_may('International')}{_may('License')}",
    "cc0-1.0": f"{_may('Creative Commons')}CC0 1.0 {_may('Universal')}",
    "copyright-reserved": f"Copyright <<var;words=1-12>>{_may(' and contributors')} All rights reserved",
    "gpl-2.0": f"{_UNDER}the {_may('terms of the')}GNU General Public License, version 2",
    "gpl-2.0-or-later": f"{_GPL}; either version 2 of the License, or (at your option) any later version. {_GPL_END}",
    "gpl-3.0": f"{_UNDER}the {_may('terms of the')}GNU General Public License, version 3",
    "gpl-3.0-or-later": f"{_GPL}, either version 3 of the License, or (at your option) any later version. {_GPL_END}",
    "isc": f"""{_COPYRIGHT} Permission to use, copy, modify, <<alt;and|and/or>> distribute this software for any purpose with or without
fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS
PROVIDED "AS IS" AND <<var;words=1-6>> DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF
MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL <<var;words=1-6>> BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL
DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR
OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "mit": f"""{_may("The MIT License")}{_may("MIT License")}{_COPYRIGHT} Permission is hereby granted, free of charge, to any person
obtaining a copy of <<alt;this|the>> software and associated documentation files (the "Software"), to deal in the Software without
restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice {_may("(including the next paragraph)")} shall be included in all copies or
substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED,
INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT
SHALL <<var;words=1-8>> BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE,
ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "mit-notice": f"{_UNDER}the {_may('terms of the')}MIT License",
    "mpl-2.0": """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not
distributed with this file, You can obtain one at <<alt;http|https>>://mozilla.org/MPL/2.0/.""",
    "public-domain": "<<alt;released into|placed in|dedicated to>> the public domain",
    "unlicense": """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish,
use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial
or non-commercial, and by any means.""",
    "zlib": """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable
for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose,
including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The
origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this
software in a product, an acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source
versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice may not be
removed or altered from any source distribution.""",
}

_SPACES = bytes(b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))
_TABLE = bytes(_SPACES[b + 32] if 0x41 <= b <= 0x5A else _SPACES[b] for b in range(256))


def words_of(text: str) -> list[bytes]:
    """Words of a text, as UTF-8."""
    return text.encode("utf-8", "surrogatepass").translate(_TABLE).split()


@dataclass(frozen=True)
class Automaton:
    """States 0..n; ``reads[s]`` is the word that state s reads (None: any word),
    ``skips[s]`` the states that follow without reading, ``done[s]`` the mandatory
    words read before it; the last state accepts.  ``leads``: the words, or pairs of
    words, that it can begin with."""

    leads: tuple[bytes, ...]
    reads: tuple[bytes | None, ...]
    skips: tuple[tuple[int, ...], ...]
    done: tuple[int, ...]
    mandatory: int

    def run(self, words: list[bytes], at: int) -> float:
        """Share of the mandatory words read from word ``at`` on; 1 if accepted."""
        end, best = len(self.reads), 0
        now = self._reach({0})
        while True:
            best = max(best, max(self.done[s] for s in now))
            if end in now:
                return 1.0
            word = words[at] if at < len(words) else None
            at += 1
            after = {s + 1 for s in now if word is not None and (self.reads[s] is None or self.reads[s] == word)}
            if not after:
                return min(best, self.mandatory - 1) / self.mandatory if self.mandatory > 1 else 0.0
            now = self._reach(after)

    def readers(self, state: int) -> list[int]:
        """The states that read a word next."""
        return [s for s in sorted(self._reach({state})) if s < len(self.reads) and self.reads[s] != b""]

    def _reach(self, states: set[int]) -> set[int]:
        todo, out = list(states), set(states)
        while todo:
            s = todo.pop()
            for t in self.skips[s] if s < len(self.skips) else ():
                if t not in out:
                    out.add(t)
                    todo.append(t)
        return out


def compile_template(markup: str) -> Automaton:
    """The automaton of a template; every word that it can begin with, mandatory or
    not, must be a given one."""
    reads: list[bytes | None] = []
    skips: dict[int, list[int]] = {}
    mandatory: list[bool] = []
    opened: list[int] = []

    def add(words: list[bytes | None], must: bool) -> None:
        reads.extend(words)
        mandatory.extend([must] * len(words))

    for part in re.split(r"(<<[^>]*>>)", markup):
        if part == _OPEN:
            opened.append(len(reads))
        elif part == _CLOSE:
            skips.setdefault(opened.pop(), []).append(len(reads))
        elif part.startswith("<<var"):
            low, high = map(int, re.search(r"words=(\d+)-(\d+)", part).groups())
            for i in range(high):
                if i >= low:
                    skips.setdefault(len(reads), []).append(len(reads) + high - i)
                add([None], False)
        elif part.startswith("<<alt;"):
            ways = [words_of(w) for w in part[6:-2].split("|")]
            end = len(reads) + sum(map(len, ways)) + len(ways)  # each way ends in a state that reads nothing
            for k, way in enumerate(ways):
                if k + 1 < len(ways):
                    skips.setdefault(len(reads), []).append(len(reads) + len(way) + 1)
                add(way, False)
                skips.setdefault(len(reads), []).append(end)
                add([b""], False)
        elif part:
            add(words_of(part), not opened)
    done = [sum(mandatory[:i]) for i in range(len(reads) + 1)]
    out = Automaton((), tuple(reads), tuple(tuple(skips.get(i, ())) for i in range(len(reads) + 1)), tuple(done), sum(mandatory))
    leads = set()
    for s in out.readers(0):
        if reads[s] is None:
            raise ValueError(f"a template begins with a given word: {markup[:60]}")
        after = [reads[t] for t in out.readers(s + 1)]
        leads |= {reads[s] + b" " + w for w in after} if after and None not in after and len(reads) not in out._reach({s + 1}) else {reads[s]}
    if not out.mandatory and not leads or len(reads) in out._reach({0}):
        raise ValueError(f"a template has words that must be there: {markup[:60]}")
    return replace(out, leads=tuple(sorted(leads)))


@functools.lru_cache(maxsize=8)
def _compiled(templates: tuple[tuple[str, str], ...]) -> list[tuple[str, Automaton]]:
    return [(label, compile_template(t)) for label, t in templates]


def places(joined: bytes, phrase: bytes) -> list[int]:
    """Word numbers at which a phrase stands in `` w0 w1 ... wn ``."""
    out, pattern = [], b" " + phrase + b" "
    at, word, last = joined.find(pattern), 0, 0
    while at >= 0:
        word += joined.count(b" ", last, at)
        last = at
        out.append(word)
        at = joined.find(pattern, at + 1)
    return out


def scan_text(text: str, templates: list[tuple[str, Automaton]], phrases: dict[str, str]) -> tuple:
    """n_words, n_base, first_word, last_word, base_labels, labels, score."""
    words = words_of(text)
    joined = b" " + b" ".join(words) + b" "
    found, base, labels, score = [], set(), set(), 0.0
    for phrase, label in phrases.items():
        if at := places(joined, phrase.encode()):
            found += at
            base.add(label)
    for label, automaton in templates:
        for at in sorted({at for lead in automaton.leads for at in places(joined, lead)}):
            got = automaton.run(words, at)
            score = max(score, got)
            if got == 1.0:
                labels.add(label)
                break
    return len(words), len(found), min(found, default=None), max(found, default=None), ",".join(sorted(base)), ",".join(sorted(base | labels)), score


def scan_licenses(docs: DataFrame, templates: dict[str, str] | None = None, phrases: dict[str, str] | None = None, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels and
    score (the largest share of a template's mandatory words found in order) of
    every row."""
    marks = tuple(sorted((TEMPLATES if templates is None else templates).items()))
    phrases = PHRASES if phrases is None else phrases
    types = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = [scan_text(t, _compiled(marks), phrases) for t in batch.column(1).to_pylist()]
        columns = [pa.array(c, kind) for c, kind in zip(zip(*rows, strict=True), types, strict=True)]
        return pa.RecordBatch.from_arrays([batch.column(0), *columns], names)

    names = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    source = docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_of(text).alias("text"))
    return map_batches(source, run, "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double")
