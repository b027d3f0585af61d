"""Known licence texts and notices. Published licence texts and
the usual one-line notices, under their SPDX identifiers."""

MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the
Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""

ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN
ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF
THIS SOFTWARE."""

ZERO_BSD = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN
ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF
THIS SOFTWARE."""

BSD_CONDITIONS = """Redistribution and use in source and binary forms, with or without modification, are permitted
provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following
disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
disclaimer in the documentation and/or other materials provided with the distribution.
"""

BSD_THIRD_CONDITION = """
3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote
products derived from this software without specific prior written permission.
"""

BSD_DISCLAIMER = """
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES,
INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL,
SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR
SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY,
WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF
THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""

ZLIB = """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be
held liable for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter
it and redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If
you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not
required.

2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original
software.

3. This notice may not be removed or altered from any source distribution."""

APACHE_HEADER = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
compliance with the License. You may obtain a copy of the License at

http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an
"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the
specific language governing permissions and limitations under the License."""

#: (identifier, text). Each text is compared whole, with a whole document or a
#: whole line of one.
KNOWN = [
    ("MIT", MIT), ("MIT", "The MIT License (MIT)\n\n" + MIT), ("MIT", "MIT License\n\n" + MIT),
    ("ISC", ISC), ("ISC", "ISC License\n\n" + ISC),
    ("0BSD", ZERO_BSD),
    ("BSD-2-Clause", BSD_CONDITIONS + BSD_DISCLAIMER),
    ("BSD-2-Clause", "BSD 2-Clause License\n\n" + BSD_CONDITIONS + BSD_DISCLAIMER),
    ("BSD-3-Clause", BSD_CONDITIONS + BSD_THIRD_CONDITION + BSD_DISCLAIMER),
    ("BSD-3-Clause", "BSD 3-Clause License\n\n" + BSD_CONDITIONS + BSD_THIRD_CONDITION + BSD_DISCLAIMER),
    ("Zlib", ZLIB), ("Zlib", "zlib License\n\n" + ZLIB),
    ("Apache-2.0", APACHE_HEADER),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("GPL-3.0-only", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0-only", "Licensed under the GNU General Public License, version 3."),
    ("GPL-3.0-only", "SPDX-License-Identifier: GPL-3.0-only"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "SPDX-License-Identifier: CC0-1.0"),
]

#: Digests (SHA-256 of the canonical form, with the equal spellings below) of whole
#: published texts that are too long to stand here. The texts are those that
#: Debian's base-files ships, the GNU ones with the address 51 Franklin Street or
#: none and with their instructions at the end. A bare text says nothing of later versions.
DIGESTS = [
    ("Apache-2.0", "4580e5390400d27df89edd0617548ac0e66eaa029f6e07cf98aac9cd100b3a37"),
    ("CC0-1.0", "6e4a79b7eaf2cdc3879a899ef330c98026c9d697ee87d41a28ac5159e8e53348"),
    ("GFDL-1.2-only", "5379e6f33e826ba185b23fd11a414555c2161fda481478babd1e73a3ae098a71"),
    ("GFDL-1.3-only", "93d6108daecdddc5f284cf8f2512fb0d72f6e9ee12381feb9704ba194b00c3e6"),
    ("GPL-1.0-only", "8f586b09c093668e2db772bdcfc1d5dc0b03e0e862fccbff035e1bf134e9b224"),
    ("GPL-2.0-only", "efe73660e5476cf0368fc0fc143f624ff9d1b73c4484b14a9969dd20c5786821"),
    ("GPL-3.0-only", "a8cd54d6683aa630f0b8d05d56184ad91dc486756da2df61c94d3e4e8d5ecb68"),
    ("LGPL-2.0-only", "61af4dcea4e412e8ccfb8877fd2762bd6d962f8d42a9fa2c06cf7b4613f2c908"),
    ("LGPL-2.1-only", "4d55922bdeafabde164d75448bbfb0b474bf952bbb541325364010900acd9891"),
    ("LGPL-3.0-only", "aae2b222477171fb64e298e7965e768a9a6f85320646b266c94399ac029d42be"),
    ("MPL-1.1", "fbe9a0b96f52e03cb474f9a7083781399c011279e85b548118563ec96e659354"),
    ("MPL-2.0", "95f6a0d094cf3da6a140310541c7b576789031b600469b70877b34f97918e4c9"),
]

#: Words that licence matching counts as equal, each with the form kept.
EQUIVALENT = {
    "acknowledgement": "acknowledgment", "analogue": "analog", "analyse": "analyze", "artefact": "artifact",
    "authorisation": "authorization", "authorised": "authorized", "calibre": "caliber", "cancelled": "canceled",
    "capitalisations": "capitalizations", "catalogue": "catalog", "categorise": "categorize", "centre": "center",
    "emphasised": "emphasized", "favour": "favor", "favourite": "favorite", "fulfil": "fulfill",
    "fulfilment": "fulfillment", "initialise": "initialize", "judgement": "judgment", "labelling": "labeling",
    "labour": "labor", "licence": "license", "licenced": "licensed", "licences": "licenses", "maximise": "maximize",
    "modelled": "modeled", "modelling": "modeling", "offence": "offense", "optimise": "optimize",
    "organisation": "organization", "organise": "organize", "practise": "practice", "programme": "program",
    "realise": "realize", "recognise": "recognize", "signalling": "signaling", "utilisation": "utilization",
    "whilst": "while", "wilful": "willful", "owner": "holder",
}
