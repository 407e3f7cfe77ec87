"""Public licence texts and notices the licence scan knows (fixed values).

Texts are given without their copyright line, which the canonical form drops
like 'All rights reserved.' and the heading lines of short licences. A name
followed by a variant in brackets is that form of the licence. More can be
passed to ``license_scan.scan`` as a table.
"""

import re

from vantage.llm.license_files import FILES

_MIT_GRANT = """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.
"""
_MIT_AS_IS = """
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE.
"""
_BSD_HEAD = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
"""
_BSD_THREE = """
3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
"""
_BSD_AS_IS = """
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE
FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL
DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR
SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER
CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY,
OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE
OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.
"""
_ISC_AS_IS = """
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH
REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY
AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM
LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR
OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR
PERFORMANCE OF THIS SOFTWARE.
"""

TEXTS = {
    "MIT": _MIT_GRANT + _MIT_AS_IS,
    "BSD-2-Clause": _BSD_HEAD + _BSD_AS_IS,
    "BSD-3-Clause": _BSD_HEAD + _BSD_THREE + _BSD_AS_IS,
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.
""" + _ISC_AS_IS,
    "0BSD": """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted.
""" + _ISC_AS_IS,
    "Zlib": """This software is provided 'as-is', without any express or implied
warranty. In no event will the authors be held liable for any damages
arising from the use of this software.

Permission is granted to anyone to use this software for any purpose,
including commercial applications, and to alter it and redistribute it
freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not
   claim that you wrote the original software. If you use this software
   in a product, an acknowledgment in the product documentation would be
   appreciated but is not required.
2. Altered source versions must be plainly marked as such, and must not be
   misrepresented as being the original software.
3. This notice may not be removed or altered from any source distribution.
""",
}

# Whole files, and their usual forms: without the part on how to apply them,
# without a title, the conditions of BSD texts with bullets instead of numbers.
TEXTS |= FILES
_END = "END OF TERMS AND CONDITIONS"
TEXTS |= {
    f"{name} (terms only)": FILES[name].split(_END)[0] + _END + "\n"
    for name in ("Apache-2.0", "GPL-1.0", "GPL-2.0", "GPL-3.0", "LGPL-2.0", "LGPL-2.1")
}
TEXTS["CC0-1.0 (no heading)"] = FILES["CC0-1.0"].partition("CC0 1.0 Universal\n")[2]
TEXTS["BSL-1.0 (no heading)"] = FILES["BSL-1.0"].partition("\n\n")[2]
TEXTS |= {f"{name} (bullets)": re.sub(r"(?m)^[123]\. ", "* ", TEXTS[name]) for name in ("BSD-2-Clause", "BSD-3-Clause")}

# One-line notices: a line that is one of these as a whole.
NOTICES = {
    "Licensed under the Apache License, Version 2.0.": "Apache-2.0",
    "Released under the MIT License.": "MIT",
    "Licensed under the MIT License.": "MIT",
    "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0",
    "Licensed under CC BY 4.0.": "CC-BY-4.0",
    "Licensed under CC BY-SA 4.0.": "CC-BY-SA-4.0",
    "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0",
    "SPDX-License-Identifier: Apache-2.0": "Apache-2.0",
    "SPDX-License-Identifier: BSD-2-Clause": "BSD-2-Clause",
    "SPDX-License-Identifier: BSD-3-Clause": "BSD-3-Clause",
    "SPDX-License-Identifier: GPL-3.0-only": "GPL-3.0",
    "SPDX-License-Identifier: ISC": "ISC",
    "SPDX-License-Identifier: MIT": "MIT",
}

NOTICES |= {
    'Licensed under the Apache License, Version 2.0 (the "License");': "Apache-2.0",
    'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.': "Apache-2.0",
    "Licensed under the Apache License, Version 2.0": "Apache-2.0",
    "Licensed under the Apache License 2.0": "Apache-2.0",
    "Distributed under the MIT License.": "MIT",
    "This project is licensed under the MIT License.": "MIT",
    "This project is licensed under the Apache License 2.0.": "Apache-2.0",
    "Use of this source code is governed by a BSD-style license that can be": "BSD-style",
    "Use of this source code is governed by an MIT-style license that can be": "MIT-style",
    "it under the terms of the GNU General Public License as published by": "GPL",
    "it under the terms of the GNU Lesser General Public License as published by": "LGPL",
    "it under the terms of the GNU Affero General Public License as published by": "AGPL",
    "modify it under the terms of the GNU General Public License": "GPL",
    "modify it under the terms of the GNU Lesser General Public": "LGPL",
    "License, v. 2.0. If a copy of the MPL was not distributed with this": "MPL-2.0",
    "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.": "MPL-2.0",
    "Distributed under the Boost Software License, Version 1.0.": "BSL-1.0",
    "This work is licensed under a Creative Commons Attribution 4.0 International License.": "CC-BY-4.0",
    "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.": "CC-BY-SA-4.0",
    "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.": "CC-BY-NC-4.0",
}
_GNU = [(f"{x}{end}", x) for x in ("GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "AGPL-3.0") for end in ("", "+", "-only", "-or-later")]
_SPDX = ("0BSD", "BSL-1.0", "CC0-1.0", "CC-BY-4.0", "CC-BY-SA-4.0", "CC-BY-NC-4.0", "MPL-2.0", "Unlicense", "Zlib")
NOTICES |= {f"SPDX-License-Identifier: {x}": name for x, name in [*_GNU, *((x, x) for x in _SPDX)]}

# Spellings taken as one (fixed values): as found -> as kept.
SPELLINGS = {
    "acknowledgement": "acknowledgment",
    "analyse": "analyze",
    "artefact": "artifact",
    "authorisation": "authorization",
    "authorised": "authorized",
    "cancelled": "canceled",
    "centre": "center",
    "copyright owner": "copyright holder",
    "copyright owners": "copyright holders",
    "favour": "favor",
    "fulfil": "fulfill",
    "https": "http",
    "initialise": "initialize",
    "judgement": "judgment",
    "labelling": "labeling",
    "labour": "labor",
    "licence": "license",
    "merchantibility": "merchantability",
    "modelling": "modeling",
    "non commercial": "noncommercial",
    "non infringement": "noninfringement",
    "offence": "offense",
    "organisation": "organization",
    "per cent": "percent",
    "practise": "practice",
    "programme": "program",
    "realise": "realize",
    "recognise": "recognize",
    "sub license": "sublicense",
    "utilisation": "utilization",
    "whilst": "while",
    "wilful": "willful",
}
