"""Whole licence texts behind license_digests.DIGESTS: short ones are given here, long ones are read from a folder of Debian's common licences.

`python -m geoloom.llm.license_texts` (from the repository) prints the table. Nothing here runs inside a query.
"""

from __future__ import annotations

import hashlib
import re
import sys
from pathlib import Path

from .license_scan import COPYRIGHT_LINE, HOLDER_LENGTH, HOLDER_START, HOLDER_WORD, NOTICES, PUNCTUATION, SPELLINGS

COMMON = Path("/usr/share/common-licenses")
#: Of the long texts: file and licence. Their first line is the title, the second often a version.
LONG = [("Apache-2.0", "Apache-2.0"), ("CC0-1.0", "CC0-1.0"), ("GPL-1", "GPL-1.0"), ("GPL-2", "GPL-2.0"), ("GPL-3", "GPL-3.0"), ("LGPL-2", "LGPL-2.0"), ("LGPL-2.1", "LGPL-2.1"), ("LGPL-3", "LGPL-3.0"), ("MPL-1.1", "MPL-1.1"), ("MPL-2.0", "MPL-2.0"), ("Artistic", "Artistic-1.0-Perl")]

_BSD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
{0}Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
{1}Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
{2}THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT {3} OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
_NEITHER = "Neither the name of the copyright {} nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.\n"
_ZLIB = """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.
Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:
1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.
3. This notice may not be removed or altered from any source distribution."""
_UNLICENSE = """This is free and unencumbered software released into the public domain.
Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.
In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.
For more information, please refer to <https://unlicense.org>"""

TITLES = {
    "MIT": ["MIT License", "The MIT License", "The MIT License (MIT)", "MIT License (MIT)"],
    "ISC": ["ISC License", "The ISC License", "ISC License (ISC)"],
    "0BSD": ["BSD Zero Clause License", "Zero-Clause BSD", "Zero-Clause BSD License", "0BSD License"],
    "BSD-2-Clause": ["BSD 2-Clause License", "The BSD 2-Clause License", "BSD-2-Clause", "Simplified BSD License"],
    "BSD-3-Clause": ["BSD 3-Clause License", "The BSD 3-Clause License", "BSD-3-Clause", "New BSD License", "Modified BSD License"],
    "Zlib": ["zlib License", "The zlib License", "The zlib/libpng License"],
    "Unlicense": ["The Unlicense", "Unlicense"],
}


def short_texts() -> list[tuple[str, str]]:
    """(licence, text) of the short texts, without a title."""
    out = [(k, v) for k, v in NOTICES if "\n" in v]
    for numbered in (True, False):
        n = ("1. ", "2. ", "3. ") if numbered else ("", "", "")
        for holder in ("HOLDER", "HOLDERS"):
            out.append(("BSD-2-Clause", _BSD.format(n[0], n[1], "", holder)))
            out += [("BSD-3-Clause", _BSD.format(n[0], n[1], n[2] + _NEITHER.format(h), holder)) for h in ("holder", "holders")]
    return [*out, ("Zlib", _ZLIB), ("Unlicense", _UNLICENSE), ("Unlicense", _UNLICENSE.rsplit("\n", 1)[0])]


def names_holder(line: str) -> bool:
    """As license_scan.names_holder()."""
    words = re.sub(HOLDER_START, "", line).replace("\t", " ").replace("\r", " ").split(" ")
    return bool(re.search(HOLDER_START, line)) and len(line) <= HOLDER_LENGTH and any(words) and all(re.fullmatch(HOLDER_WORD, w) for w in words if w)


def canonical(text: str) -> str:
    """The canonical form of a text, as license_scan makes it."""
    out = []
    for line in text.split("\n"):
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in line)
        words = " " + re.sub(PUNCTUATION, " ", "" if re.search(COPYRIGHT_LINE, low) or names_holder(line) else low) + " "
        for old, new in SPELLINGS:
            words = words.replace(f" {old} ", f" {new} ")
        out.append(re.sub(" +", " ", words).strip(" "))
    return " ".join(x for x in out if x)


def variants(folder: Path = COMMON) -> list[tuple[str, str]]:
    """(licence, text) of all texts: with each title, without, and long ones also without what follows their terms. Titles alone are notices, too."""
    out = [(k, t) for k, titles in TITLES.items() for t in titles]
    for k, text in short_texts():
        out += [(k, text), *((k, f"{t}\n{text}") for t in TITLES[k])]
    for name, k in LONG if folder.is_dir() else []:
        text = (folder / name).read_text(encoding="utf-8")
        lines = text.strip("\n").split("\n")
        untitled = [x for i, x in enumerate(lines) if i > 1 or not re.search("licen[sc]e|version|cc0|universal|^=*$", x, re.I)]
        for form in (lines, untitled):
            end = [i for i, x in enumerate(form) if re.search("END OF TERMS AND CONDITIONS", x)]
            out += [(k, "\n".join(form)), *((k, "\n".join(form[:at])) for i in end[-1:] for at in (i, i + 1))]
    return out


if __name__ == "__main__":
    rows = sorted({(k, hashlib.sha256(canonical(t).encode()).hexdigest()) for k, t in variants()})
    sys.stdout.write('"""Digests of whole licence texts and their titles, as license_texts.py prints them."""\n\nDIGESTS = [\n')
    sys.stdout.writelines(f'    ("{k}", "{d}"),\n' for k, d in rows)
    sys.stdout.write("]\n")
