"""Public licence texts and notices, and spellings the SPDX matching guidelines treat as equal."""

MIT = """MIT License

Copyright (c) <year> <copyright holders>

Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""

ISC = """ISC License

Copyright (c) <year> <owner>

Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""

ZERO_BSD = """BSD Zero Clause License

Copyright (c) <year> <owner>

Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""

BSD_TWO = """BSD 2-Clause License

Copyright (c) <year>, <owner>
All rights reserved.

Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""

BSD_THREE = BSD_TWO.replace("BSD 2-Clause License", "BSD 3-Clause License").replace(
    "THIS SOFTWARE IS PROVIDED BY",
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
    "products derived from this software without specific prior written permission.\n\nTHIS SOFTWARE IS PROVIDED BY", 1)

UNLICENSE = """This is free and unencumbered software released into the public domain.

Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.

In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.

For more information, please refer to <https://unlicense.org>"""

APACHE_HEADER = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."""

#: (SPDX identifier, text); a licence may have several texts.
TEXTS = (
    ("MIT", MIT), ("MIT", "Released under the MIT License."), ("MIT", "Licensed under the MIT License."),
    ("ISC", ISC), ("0BSD", ZERO_BSD), ("BSD-2-Clause", BSD_TWO), ("BSD-3-Clause", BSD_THREE),
    ("Unlicense", UNLICENSE), ("Apache-2.0", APACHE_HEADER),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."), ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."), ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC0-1.0", "Licensed under CC0 1.0."),
    # without the title
    *[(name, text.partition("\n")[2]) for name, text in (
        ("MIT", MIT), ("ISC", ISC), ("0BSD", ZERO_BSD), ("BSD-2-Clause", BSD_TWO), ("BSD-3-Clause", BSD_THREE))],
)

#: (SPDX identifier, first words, length and SHA-256 of the canonical form) of longer texts, up to
#: "END OF TERMS AND CONDITIONS" and, where more follows, as a whole; formed by ``licenses.shape``.
FULL_TEXTS = (
    ("Apache-2.0", "apache license version 2 0 january 2004 http", 8870, "119e2da0e9ec849d113a40405b338c1bbbd2ef9194c22bf2740fa4e195411c40"),
    ("Apache-2.0", "apache license version 2 0 january 2004 http", 9886, "04e64e0427d80fdde16fa8415931bf2c09bc943f13ec322a09df188bf23a3543"),
    ("Artistic-1.0-Perl", "the artistic license preamble the intent of this", 5833, "08f1dc258c8f9e175155356aa1dd0dead8cfdec586bc1bb4c8b1452699a91702"),
    ("BSD-3-Clause", "redistribution and use in source and binary forms", 1361, "21ce5e311a0ef74591e636cf6d0a236029bcaa0ee86324ac68d5748657aa8651"),
    ("CC0-1.0", "creative commons legal code cc0 1 0 universal", 6696, "96f9b6f44f60a039539ef5cba12c6d4365c81621ff3a06ac37a3db1d5c225621"),
    ("GFDL-1.2", "gnu free documentation license version 1 2 november", 19583, "94541e73869af10ab6bd68a29575eede324e54e7d5237e7386d12444f593af60"),
    ("GFDL-1.3", "gnu free documentation license version 1 3 3", 22018, "a92fdbaeafedd9cbeb812ebbded06ee07e3b1427c81cfc333e682109c594d826"),
    ("GPL-1.0", "gnu general public license version 1 february 1989", 9415, "6375a768fd262bf5281905a9585411d2d0fb4ea15cb08cfcba49f73fedb82abc"),
    ("GPL-1.0", "gnu general public license version 1 february 1989", 11765, "8f586b09c093668e2db772bdcfc1d5dc0b03e0e862fccbff035e1bf134e9b224"),
    ("GPL-2.0", "gnu general public license version 2 june 1991", 14483, "e1270b653c300290e7c039142bccb8776f9b5d14e8a05bc4e87dc7d1614a3b34"),
    ("GPL-2.0", "gnu general public license version 2 june 1991", 17117, "efe73660e5476cf0368fc0fc143f624ff9d1b73c4484b14a9969dd20c5786821"),
    ("GPL-3.0", "gnu general public license version 3 29 june", 30968, "ac6b52d57c0104e687039148f7b8e370e04c9bb5705bb786f8ef814eb65e8636"),
    ("GPL-3.0", "gnu general public license version 3 29 june", 33406, "eaab5d82fdcca441d83a1913bbf07e4de3a739e190578c0bffde24f84e93bb2a"),
    ("LGPL-2.0", "gnu library general public license version 2 june", 22277, "504542bce5421b0f5a7e63ddb55443ccb300b27a65ba6bfc1370fed16a3af260"),
    ("LGPL-2.0", "gnu library general public license version 2 june", 24130, "61af4dcea4e412e8ccfb8877fd2762bd6d962f8d42a9fa2c06cf7b4613f2c908"),
    ("LGPL-2.1", "gnu lesser general public license version 2 1", 23365, "48d2010e70a815a564f914b0c7c1e80d7a6843793348fed3684c957112fe0aa4"),
    ("LGPL-2.1", "gnu lesser general public license version 2 1", 25217, "4d55922bdeafabde164d75448bbfb0b474bf952bbb541325364010900acd9891"),
    ("LGPL-3.0", "gnu lesser general public license version 3 29", 7104, "aae2b222477171fb64e298e7965e768a9a6f85320646b266c94399ac029d42be"),
    ("MPL-1.1", "mozilla public license version 1 1 1 definitions", 22467, "a1b36de49a400e3d3385d5987188db954a084f9876243aa7207cd91de3f24a7b"),
    ("MPL-2.0", "mozilla public license version 2 0 1 definitions", 14341, "f82071285728ca3ec7685ee9bc4acdae0b8267142a4d20b8f1805eabedb4a98a"),
)

#: Spellings that count as the word after them.
EQUIVALENT = {
    "acknowledgement": "acknowledgment", "analogue": "analog", "analyse": "analyze", "artefact": "artifact",
    "authorisation": "authorization", "authorised": "authorized", "calibre": "caliber", "cancelled": "canceled",
    "capitalisations": "capitalizations", "catalogue": "catalog", "categorise": "categorize", "centre": "center",
    "emphasised": "emphasized", "favour": "favor", "favourite": "favorite", "fulfil": "fulfill",
    "fulfilment": "fulfillment", "initialise": "initialize", "judgement": "judgment", "labelling": "labeling",
    "labour": "labor", "licence": "license", "licenced": "licensed", "licences": "licenses", "licencing": "licensing",
    "maximise": "maximize", "modelled": "modeled", "modelling": "modeling", "offence": "offense",
    "optimise": "optimize", "organisation": "organization", "organise": "organize", "practise": "practice",
    "programme": "program", "realise": "realize", "recognise": "recognize", "recognised": "recognized",
    "signalling": "signaling", "sublicence": "sublicense", "utilisation": "utilization", "whilst": "while",
    "wilful": "willful", "https": "http", "owner": "holder", "owners": "holders",
}

#: Phrases of several words, after punctuation is gone, that count as the phrase after them.
PHRASES = {
    "non infringement": "noninfringement", "non commercial": "noncommercial", "sub license": "sublicense",
    "sub licensed": "sublicensed", "per cent": "percent",
}
