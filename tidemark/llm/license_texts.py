"""Licence wordings that the scan knows: whole texts and notices as published, and one-line references made by a rule.

Long texts lie in ``license_files``, as published, a file for each licence.
"""

from importlib import resources

# Published licence texts and notices, without copyright lines.
MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""

ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""

BSD_HEAD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
"""

BSD_THIRD = """
3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.
"""

BSD_TAIL = """
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""

APACHE_NOTICE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at

http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."""

GPL_NOTICE = """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version {version} of the License, or (at your option) any later version.

This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."""

FULL = {
    "MIT": [MIT],
    "ISC": [ISC],
    "BSD-2-Clause": [BSD_HEAD + BSD_TAIL],
    "BSD-3-Clause": [BSD_HEAD + BSD_THIRD + BSD_TAIL],
    "Apache-2.0": [APACHE_NOTICE],
    "GPL-2.0": [GPL_NOTICE.format(version=2)],
    "GPL-3.0": [GPL_NOTICE.format(version=3)],
}

# The names by which one-line references call a licence.
NAMES = {
    "MIT": ["MIT License"],
    "ISC": ["ISC License"],
    "Apache-2.0": ["Apache License, Version 2.0", "Apache License 2.0"],
    "GPL-2.0": ["GNU General Public License, version 2", "GNU General Public License v2.0"],
    "GPL-3.0": ["GNU General Public License, version 3", "GNU General Public License v3.0"],
    "LGPL-3.0": ["GNU Lesser General Public License, version 3"],
    "AGPL-3.0": ["GNU Affero General Public License, version 3"],
    "MPL-2.0": ["Mozilla Public License, version 2.0"],
    "CC-BY-4.0": ["CC BY 4.0", "Creative Commons Attribution 4.0 International License"],
    "CC-BY-SA-4.0": ["CC BY-SA 4.0", "Creative Commons Attribution-ShareAlike 4.0 International License"],
    "CC-BY-NC-4.0": ["CC BY-NC 4.0", "Creative Commons Attribution-NonCommercial 4.0 International License"],
    "CC-BY-ND-4.0": ["CC BY-ND 4.0"],
    "CC-BY-NC-SA-4.0": ["CC BY-NC-SA 4.0"],
    "CC0-1.0": ["CC0 1.0"],
}


# The licences whose long texts lie in files.
FILES = ["Apache-2.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "MPL-2.0", "CC0-1.0"]


def long_text(name: str) -> str:
    return (resources.files(__package__) / "license_files" / f"{name}.txt").read_text(encoding="utf-8")


def templates() -> list[tuple[str, str]]:
    """(licence, wording) of all whole texts and notices, then of all one-line references, then of all long texts."""
    out = [(k, t) for k, texts in FULL.items() for t in texts]
    out += [(k, f"licensed under {'the ' if 'License' in n else ''}{n}") for k, names in NAMES.items() for n in names]
    out += [(k, f"released under {'the ' if 'License' in n else ''}{n}") for k, names in NAMES.items() for n in names]
    out += [(k, f"SPDX-License-Identifier: {k}") for k in NAMES]
    return out + [(k, long_text(k)) for k in FILES]
