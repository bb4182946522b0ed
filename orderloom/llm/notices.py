"""License templates: one-line notices, file headers, paragraphs and whole texts.

Notices of a family differ in a word or two (version, Lesser, Affero, BY / SA / ND), so every
member has its own template and the scan reports the one that explains a place best. Whole texts
lie in ``license_texts``. They are the published ones, but for the Affero license, which is
version 3 of the General Public License with Affero's preamble and sections 13 and 14. All else was
typed; ``published`` compares it with the published files.
"""

import re
from importlib import resources

NOTICES = {
    "all-rights-reserved": "All rights reserved.",
    "mit-notice": "Released under the MIT License.",
    "apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "cc-by-nc-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "gpl-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "apache-1.1-notice": "Licensed under the Apache License, Version 1.1.",
    "cc0-1.0-notice": "Licensed under CC0 1.0.",
    "isc-notice": "Released under the ISC License.",
    "unlicense-notice": "Released under the Unlicense.",
    "zlib-notice": "Released under the zlib License.",
    "bsl-1.0-notice": "Distributed under the Boost Software License, Version 1.0.",
    "epl-1.0-notice": "Licensed under the Eclipse Public License, Version 1.0.",
    "epl-2.0-notice": "Licensed under the Eclipse Public License, Version 2.0.",
    "mpl-1.1-notice": "Licensed under the Mozilla Public License, Version 1.1.",
    "mpl-2.0-notice": "Licensed under the Mozilla Public License, Version 2.0.",
    "bsd-notice": "Released under the BSD License.",
    "bsd-2-clause-notice": "Released under the BSD 2-Clause License.",
    "bsd-3-clause-notice": "Released under the BSD 3-Clause License.",
}

#: Files that are no published text, and words up to which a text may stand in a file by chance.
PUT_TOGETHER, FEWEST_WORDS = ("agpl-3.0.txt",), 8

#: Words of a notice that name nothing; all others must be there.
GENERIC = frozenset("0 a all attribution by clause commons creative creativecommons distributed general "
                    "generic international is license licensed licenses org public released reserved "
                    "rights software the this to under unported version work".split())

PARAGRAPHS = {
    "cc0-1.0-dedication":
        "To the extent possible under law, the author has waived all copyright and related or "
        "neighboring rights to this work.",
    "mit-permission":
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        "software and associated documentation files (the \"Software\"), to deal in the Software "
        "without restriction, including without limitation the rights to use, copy, modify, merge, "
        "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons "
        "to whom the Software is furnished to do so, subject to the following conditions:",
    "mit-condition":
        "The above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the Software.",
    "mit-warranty":
        "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, "
        "INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR "
        "PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE "
        "FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR "
        "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER "
        "DEALINGS IN THE SOFTWARE.",
    "apache-2.0-header":
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file "
        "except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0",
    "apache-2.0-header-warranty":
        "Unless required by applicable law or agreed to in writing, software distributed under the "
        "License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, "
        "either express or implied. See the License for the specific language governing permissions "
        "and limitations under the License.",
    "bsd-redistribution":
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met:",
    "bsd-source":
        "Redistributions of source code must retain the above copyright notice, this list of "
        "conditions and the following disclaimer.",
    "bsd-binary":
        "Redistributions in binary form must reproduce the above copyright notice, this list of "
        "conditions and the following disclaimer in the documentation and/or other materials "
        "provided with the distribution.",
    "bsd-advertising":
        "All advertising materials mentioning features or use of this software must display the "
        "following acknowledgement:",
    "bsd-endorsement":
        "Neither the name of the copyright holder nor the names of its contributors may be used to "
        "endorse or promote products derived from this software without specific prior written "
        "permission.",
    "bsd-disclaimer":
        "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY "
        "EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF "
        "MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE "
        "COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, "
        "EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF "
        "SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) "
        "HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR "
        "TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS "
        "SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
    "isc-permission":
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
        "without fee is hereby granted, provided that the above copyright notice and this permission "
        "notice appear in all copies.",
    "isc-warranty":
        "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO "
        "THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT "
        "SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR "
        "ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF "
        "CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE "
        "OR PERFORMANCE OF THIS SOFTWARE.",
    "0bsd-permission":
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
        "without fee is hereby granted.",
    "unlicense-dedication":
        "This is free and unencumbered software released into the public domain. Anyone is free to "
        "copy, modify, publish, use, compile, sell, or distribute this software, either in source "
        "code form or as a compiled binary, for any purpose, commercial or non-commercial, and by "
        "any means.",
    "unlicense-domain":
        "In jurisdictions that recognize copyright laws, the author or authors of this software "
        "dedicate any and all copyright interest in the software to the public domain. We make this "
        "dedication for the benefit of the public at large and to the detriment of our heirs and "
        "successors. We intend this dedication to be an overt act of relinquishment in perpetuity of "
        "all present and future rights to this software under copyright law.",
    "zlib-permission":
        "This software is provided 'as-is', without any express or implied warranty. In no event "
        "will the authors be held liable for any damages arising from the use of this software. "
        "Permission is granted to anyone to use this software for any purpose, including commercial "
        "applications, and to alter it and redistribute it freely, subject to the following "
        "restrictions:",
    "zlib-restrictions":
        "1. The origin of this software must not be misrepresented; you must not claim that you wrote "
        "the original software. If you use this software in a product, an acknowledgment in the "
        "product documentation would be appreciated but is not required. 2. Altered source versions "
        "must be plainly marked as such, and must not be misrepresented as being the original "
        "software. 3. This notice may not be removed or altered from any source distribution.",
    "bsl-1.0-permission":
        "Permission is hereby granted, free of charge, to any person or organization obtaining a copy "
        "of the software and accompanying documentation covered by this license (the \"Software\") to "
        "use, reproduce, display, distribute, execute, and transmit the Software, and to prepare "
        "derivative works of the Software, and to permit third-parties to whom the Software is "
        "furnished to do so, all subject to the following:",
    "mpl-2.0-header":
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a "
        "copy of the MPL was not distributed with this file, You can obtain one at "
        "http://mozilla.org/MPL/2.0/.",
    "mpl-1.1-header":
        "The contents of this file are subject to the Mozilla Public License Version 1.1 (the "
        "\"License\"); you may not use this file except in compliance with the License. You may obtain "
        "a copy of the License at http://www.mozilla.org/MPL/",
    "epl-2.0-header":
        "This program and the accompanying materials are made available under the terms of the "
        "Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/",
    "epl-1.0-header":
        "This program and the accompanying materials are made available under the terms of the "
        "Eclipse Public License v1.0 which accompanies this distribution, and is available at "
        "http://www.eclipse.org/legal/epl-v10.html",
}

_GNU = {"gpl-1.0": ("program", "GNU General Public License", "1"),
        "gpl-2.0": ("program", "GNU General Public License", "2"),
        "gpl-3.0": ("program", "GNU General Public License", "3"),
        "lgpl-2.0": ("library", "GNU Library General Public License", "2"),
        "lgpl-2.1": ("library", "GNU Lesser General Public License", "2.1"),
        "lgpl-3.0": ("program", "GNU Lesser General Public License", "3"),
        "agpl-3.0": ("program", "GNU Affero General Public License", "3")}
_KINDS = {"by": "Attribution", "by-sa": "Attribution-ShareAlike", "by-nd": "Attribution-NoDerivatives",
          "by-nc": "Attribution-NonCommercial", "by-nc-sa": "Attribution-NonCommercial-ShareAlike",
          "by-nc-nd": "Attribution-NonCommercial-NoDerivatives"}
_PORTS = {"1.0": "Generic", "2.0": "Generic", "2.5": "Generic", "3.0": "Unported", "4.0": "International"}


def gnu() -> tuple[dict[str, str], dict[str, str]]:
    """Notices and headers of the GNU licenses."""
    short, long = {}, {}
    for name, (thing, title, version) in _GNU.items():
        short[f"{name}-notice"] = f"This work is licensed under the {title}, version {version}."
        start = (f"This {thing} is free software: you can redistribute it and/or modify it under the terms "
                 f"of the {title} as published by the Free Software Foundation, ")
        long[f"{name}-header"] = (start + f"either version {version} of the License, or (at your option) "
                                  "any later version.")
        long[f"{name}-only-header"] = start + f"version {version} of the License."
    for name, title in (("gpl", "GNU General Public License"), ("lgpl", "GNU Lesser General Public License"),
                        ("agpl", "GNU Affero General Public License")):
        thing = "library" if name == "lgpl" else "program"
        long[f"{name}-warranty"] = (
            f"This {thing} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; "
            "without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. "
            f"See the {title} for more details.")
    return short, long


def creative_commons() -> tuple[dict[str, str], dict[str, str]]:
    """Notices of every kind and version, in short, in full and as the address, and the first
    paragraph of version 4.0."""
    short, long = {}, {}
    for kind, title in _KINDS.items():
        for version, port in _PORTS.items():
            name = f"cc-{kind}-{version}"
            named = title if version == "4.0" else title.replace("NoDerivatives", "NoDerivs")
            short[f"{name}-notice"] = f"Licensed under CC {kind.upper()} {version}."
            short[f"{name}-full-notice"] = (
                f"This work is licensed under a Creative Commons {named} {version} {port} License.")
            short[f"{name}-address"] = f"creativecommons.org/licenses/{kind}/{version}"
        long[f"cc-{kind}-4.0-acceptance"] = (
            "By exercising the Licensed Rights (defined below), You accept and agree to be bound by the "
            f"terms and conditions of this Creative Commons {title} 4.0 International Public License "
            "(\"Public License\"). To the extent this Public License may be interpreted as a contract, You "
            "are granted the Licensed Rights in consideration of Your acceptance of these terms and "
            "conditions, and the Licensor grants You such rights in consideration of benefits the Licensor "
            "receives from making the Licensed Material available under these terms and conditions.")
    return short, long


def whole_texts() -> dict[str, str]:
    """The licenses that have a file, and those that are a few of the paragraphs."""
    folder = resources.files("orderloom.llm") / "license_texts"
    texts = {f"{f.name.removesuffix('.txt')}-text": f.read_text("utf-8")
             for f in sorted(folder.iterdir(), key=lambda f: f.name)}
    join = lambda *names: " ".join(PARAGRAPHS[n] for n in names)
    bsd = "bsd-redistribution", "bsd-source", "bsd-binary"
    return texts | {
        "mit-text": join("mit-permission", "mit-condition", "mit-warranty"),
        "bsd-2-clause-text": join(*bsd, "bsd-disclaimer"),
        "bsd-3-clause-text": join(*bsd, "bsd-endorsement", "bsd-disclaimer"),
        "bsd-4-clause-text": join(*bsd, "bsd-advertising", "bsd-endorsement", "bsd-disclaimer"),
        "isc-text": join("isc-permission", "isc-warranty"),
        "0bsd-text": join("0bsd-permission", "isc-warranty"),
        "zlib-text": join("zlib-permission", "zlib-restrictions"),
        "unlicense-text": join("unlicense-dedication", "unlicense-domain", "mit-warranty"),
        "apache-2.0-header-text": join("apache-2.0-header", "apache-2.0-header-warranty")}


def published(texts: dict[str, str]) -> frozenset[str]:
    """The names of texts whose words stand in a row in one of the published files."""
    folder = resources.files("orderloom.llm") / "license_texts"
    words = lambda text: f" {' '.join(re.findall('[a-z0-9]+', text.lower()))} "
    files = [words(f.read_text("utf-8")) for f in folder.iterdir() if f.name not in PUT_TOGETHER]
    return frozenset(n for n, t in texts.items() if len(words(t).split()) > FEWEST_WORDS
                     and any(words(t) in f for f in files))


def templates() -> tuple[dict[str, str], frozenset[str]]:
    """All texts by name, and the names of those that are notices."""
    (gnu_short, gnu_long), (cc_short, cc_long) = gnu(), creative_commons()
    short = NOTICES | gnu_short | cc_short
    return short | PARAGRAPHS | gnu_long | cc_long | whole_texts(), frozenset(short)
