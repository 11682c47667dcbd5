"""Licence scans by sentence rules, with DataFrame functions only.

1. Take off comment leaders, and mend what would part a known sentence: abbreviations before a number, a URL in a paragraph
   of its own, SPDX tags.
2. Cut a text into sentences in two ways: by lines as well as by full stops, and by full stops in paragraphs whose lines
   are joined, for licence texts that are wrapped.
3. Normalise each sentence to lower-case letters and digits with single spaces.
4. Map it to the identifier of a known licence sentence, or of a template whose holder, name or place is open. An SPDX tag
   gives an identifier for each name of its expression, whatever its length and brackets, with an exception after WITH.
   A sentence that speaks of a licence but isn't known is UNKNOWN.
5. Match the sequence of known identifiers against rules in order, longer ones first: a rule whose identifiers follow
   one another gives its licence and uses them up. No rule matches across what another one used up. "All rights reserved"
   doesn't count by itself beside a sentence that speaks of an unknown licence.

It is one projection: no shuffle, no state, so a hot source or a group of copies can't weigh on one task. Texts without
any word that every known sentence and every licence sentence has one of aren't cut at all.
"""
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Public licence sentences in normal form, by identifier.
SENTENCES = {
    "mit-ref": ["released under the mit license", "licensed under the mit license", "this project is licensed under the mit license"],
    "mit-grant": ["permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions"],
    "mit-notice": ["the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"],
    "mit-warranty": ["the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement"],
    "mit-liability": ["in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software"],
    "isc-grant": ["permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies"],
    "bsd-ref": ["licensed under the bsd license", "released under the bsd license"],
    "bsd-grant": ["redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"],
    "bsd-source": ["redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer", "1 redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer"],
    "bsd-binary": ["redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution", "2 redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution"],
    "bsd-endorse": ["neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission", "3 neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission"],
    "apache2-ref": ["licensed under the apache license version 2 0", "released under the apache license version 2 0", "licensed under the apache license version 2 0 the license"],
    "apache2-use": ["you may not use this file except in compliance with the license", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license"],
    "apache2-copy": ["you may obtain a copy of the license at http www apache org licenses license 2 0", "you may obtain a copy of the license at https www apache org licenses license 2 0"],
    "apache2-basis": ["unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied"],
    "apache2-see": ["see the license for the specific language governing permissions and limitations under the license"],
    "gpl3-ref": ["this work is licensed under the gnu general public license version 3", "licensed under the gnu general public license version 3"],
    "gpl2-ref": ["this work is licensed under the gnu general public license version 2", "licensed under the gnu general public license version 2"],
    "gpl3-later": ["this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version", "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version"],
    "gpl2-later": ["this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version", "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version"],
    "gpl-warranty": ["this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose"],
    "gpl-see": ["see the gnu general public license for more details"],
    "gpl-received": ["you should have received a copy of the gnu general public license along with this program", "you should have received a copy of the gnu general public license along with this program if not see http www gnu org licenses", "you should have received a copy of the gnu general public license along with this program if not see https www gnu org licenses", "you should have received a copy of the gnu general public license along with this program if not write to the free software foundation inc 51 franklin street fifth floor boston ma 02110 1301 usa"],
    "lgpl3-ref": ["this work is licensed under the gnu lesser general public license version 3", "licensed under the gnu lesser general public license version 3"],
    "agpl3-ref": ["this work is licensed under the gnu affero general public license version 3", "licensed under the gnu affero general public license version 3"],
    "mpl2-ref": ["this source code form is subject to the terms of the mozilla public license v 2 0", "licensed under the mozilla public license version 2 0"],
    "mpl2-obtain": ["if a copy of the mpl was not distributed with this file you can obtain one at http mozilla org mpl 2 0", "if a copy of the mpl was not distributed with this file you can obtain one at https mozilla org mpl 2 0"],
    "cc-by4-ref": ["licensed under cc by 4 0", "this work is licensed under a creative commons attribution 4 0 international license", "this work is licensed under the creative commons attribution 4 0 international license"],
    "cc-by-sa4-ref": ["licensed under cc by sa 4 0", "this work is licensed under a creative commons attribution sharealike 4 0 international license"],
    "cc-by-nc4-ref": ["licensed under cc by nc 4 0", "this work is licensed under a creative commons attribution noncommercial 4 0 international license"],
    "cc-by-nd4-ref": ["licensed under cc by nd 4 0", "this work is licensed under a creative commons attribution noderivatives 4 0 international license"],
    "cc0-ref": ["licensed under cc0 1 0", "released under cc0 1 0"],
    "unlicense-grant": ["this is free and unencumbered software released into the public domain"],
    "mit-title": ["mit license", "the mit license", "the mit license mit", "mit license mit"],
    "bsd2-title": ["bsd 2 clause license", "the bsd 2 clause license"],
    "bsd3-title": ["bsd 3 clause license", "the bsd 3 clause license"],
    "bsd-advert": ["all advertising materials mentioning features or use of this software must display the following acknowledgement", "3 all advertising materials mentioning features or use of this software must display the following acknowledgement"],
    "bsd-disclaimer": ["this software is provided by the copyright holders and contributors as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed"],
    "bsd-liability": ["in no event shall the copyright holder or contributors be liable for any direct indirect incidental special exemplary or consequential damages including but not limited to procurement of substitute goods or services loss of use data or profits or business interruption however caused and on any theory of liability whether in contract strict liability or tort including negligence or otherwise arising in any way out of the use of this software even if advised of the possibility of such damage", "in no event shall the copyright holders or contributors be liable for any direct indirect incidental special exemplary or consequential damages including but not limited to procurement of substitute goods or services loss of use data or profits or business interruption however caused and on any theory of liability whether in contract strict liability or tort including negligence or otherwise arising in any way out of the use of this software even if advised of the possibility of such damage"],
    "isc-title": ["isc license", "the isc license", "isc license isc"],
    "isc-warranty": ["the software is provided as is and the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness"],
    "isc-liability": ["in no event shall the author be liable for any special direct indirect or consequential damages or any damages whatsoever resulting from loss of use data or profits whether in an action of contract negligence or other tortious action arising out of or in connection with the use or performance of this software"],
    "zlib-title": ["zlib license", "the zlib license"],
    "zlib-warranty": ["this software is provided as is without any express or implied warranty"],
    "zlib-liability": ["in no event will the authors be held liable for any damages arising from the use of this software"],
    "zlib-grant": ["permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions"],
    "zlib-origin": ["the origin of this software must not be misrepresented you must not claim that you wrote the original software"],
    "zlib-altered": ["altered source versions must be plainly marked as such and must not be misrepresented as being the original software"],
    "zlib-notice": ["this notice may not be removed or altered from any source distribution"],
    "boost-title": ["boost software license version 1 0 august 17th 2003", "boost software license version 1 0"],
    "boost-ref": ["distributed under the boost software license version 1 0", "licensed under the boost software license version 1 0"],
    "boost-see": ["see accompanying file license 1 0 txt or copy at http www boost org license 1 0 txt", "see accompanying file license 1 0 txt or copy at https www boost org license 1 0 txt"],
    "boost-grant": ["permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license the software to use reproduce display distribute execute and transmit the software and to prepare derivative works of the software and to permit third parties to whom the software is furnished to do so all subject to the following"],
    "boost-notice": ["the copyright notices in the software and this entire statement including the above license grant this restriction and the following disclaimer must be included in all copies of the software in whole or in part and all derivative works of the software unless such copies or derivative works are solely in the form of machine executable object code generated by a source language processor"],
    "boost-warranty": ["the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose title and non infringement"],
    "boost-liability": ["in no event shall the copyright holders or anyone distributing the software be liable for any damages or other liability whether in contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software"],
    "epl2-ref": ["this program and the accompanying materials are made available under the terms of the eclipse public license 2 0 which is available at https www eclipse org legal epl 2 0", "this program and the accompanying materials are made available under the terms of the eclipse public license 2 0 which is available at http www eclipse org legal epl 2 0", "this program and the accompanying materials are made available under the terms of the eclipse public license v 2 0 which is available at https www eclipse org legal epl 2 0", "licensed under the eclipse public license version 2 0"],
    "epl1-ref": ["this program and the accompanying materials are made available under the terms of the eclipse public license v1 0 which accompanies this distribution and is available at http www eclipse org legal epl v10 html", "licensed under the eclipse public license version 1 0"],
    "artistic2-ref": ["the artistic license 2 0", "artistic license 2 0", "licensed under the artistic license 2 0"],
    "apache-title": ["apache license"],
    "apache2-version": ["version 2 0 january 2004"],
    "gpl-title": ["gnu general public license"],
    "gpl3-version": ["version 3 29 june 2007"],
    "gpl2-version": ["version 2 june 1991"],
    "lgpl21-ref": ["this work is licensed under the gnu lesser general public license version 2 1", "licensed under the gnu lesser general public license version 2 1"],
    "lgpl21-later": ["you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 2 1 of the license or at your option any later version", "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 2 1 of the license or at your option any later version", "this program is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 2 1 of the license or at your option any later version"],
    "lgpl3-later": ["you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version", "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version", "this program is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version"],
    "agpl3-later": ["you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version", "this library is free software you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version", "this program is free software you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version"],
    "lgpl-warranty": ["this library is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose"],
    "lgpl-see": ["see the gnu lesser general public license for more details"],
    "agpl-see": ["see the gnu affero general public license for more details"],
    "lgpl-received": ["you should have received a copy of the gnu lesser general public license along with this library", "you should have received a copy of the gnu lesser general public license along with this library if not see http www gnu org licenses", "you should have received a copy of the gnu lesser general public license along with this library if not see https www gnu org licenses", "you should have received a copy of the gnu lesser general public license along with this program", "you should have received a copy of the gnu lesser general public license along with this program if not see http www gnu org licenses", "you should have received a copy of the gnu lesser general public license along with this program if not see https www gnu org licenses"],
    "agpl-received": ["you should have received a copy of the gnu affero general public license along with this program", "you should have received a copy of the gnu affero general public license along with this program if not see http www gnu org licenses", "you should have received a copy of the gnu affero general public license along with this program if not see https www gnu org licenses"],
    "gnu-url": ["if not see http www gnu org licenses", "if not see https www gnu org licenses"],
    "cc-by4-view": ["to view a copy of this license visit http creativecommons org licenses by 4 0", "to view a copy of this license visit https creativecommons org licenses by 4 0", "to view a copy of this license visit http creativecommons org licenses by 4 0 or send a letter to creative commons po box 1866 mountain view ca 94042 usa"],
    "rights": ["all rights reserved"],
    "asf-agreements": ["licensed to the apache software foundation asf under one or more contributor license agreements"],
    "apache2-asf": ["the asf licenses this file to you under the apache license version 2 0 the license you may not use this file except in compliance with the license", "the asf licenses this file to you under the apache license version 2 0", "the asf licenses this file to you under the apache license version 2 0 the license"],
    "apache2-ref mit-ref": ["licensed under either of apache license version 2 0 or mit license", "licensed under either of apache license version 2 0 or mit license at your option", "licensed under either the mit license or the apache license version 2 0", "licensed under the mit license or the apache license version 2 0 at your option", "dual licensed under mit and apache 2 0", "licensed under either of apache license version 2 0 license apache or http www apache org licenses license 2 0 mit license license mit or http opensource org licenses mit at your option", "licensed under either of apache license version 2 0 license apache or https www apache org licenses license 2 0 mit license license mit or https opensource org licenses mit at your option"],
}

# Public licence sentences in normal form with an open part, as patterns of the whole sentence.
TEMPLATES = {
    "bsd-endorse": "(?:3 )?neither the names? of .+ may be used to endorse or promote products derived from this software without specific prior written permission",
    "bsd-disclaimer": "this software is provided by .+ as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed",
    "bsd-liability": "in no event shall .+ be liable for any direct indirect incidental special exemplary or consequential damages .+ even if advised of the possibility of such damage",
    "bsd-style-ref": "use of this source code is governed by an? (?:new )?bsd style license that can be found in the license file.*",
    "mit-ref": "use of this source code is governed by an? mit style license that can be found in the license file.*",
    "mit-liability": "in no event shall .+ be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software",
    "isc-warranty": "the software is provided as is and .+ disclaims? all warranties with regard to this software including all implied warranties of merchantability and fitness",
    "isc-liability": "in no event shall .+ be liable for any special direct indirect or consequential damages or any damages whatsoever resulting from loss of use data or profits .+ arising out of or in connection with the use or performance of this software",
    "gpl2-only": "(?:.+ )?you can redistribute it and or modify it under the terms of (?:the gnu general public license version 2|version 2 of the gnu general public license) (?:only )?as published by the free software foundation",
    "gpl3-only": "(?:.+ )?you can redistribute it and or modify it under the terms of (?:the gnu general public license version 3|version 3 of the gnu general public license) (?:only )?as published by the free software foundation",
    "gpl2-later": ".+ you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version",
    "gpl3-later": ".+ you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "lgpl21-later": ".+ you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 2 1 of the license or at your option any later version",
    "lgpl3-later": ".+ you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "agpl3-later": ".+ you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "gpl-warranty": ".+ is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose",
    "gpl-received": "you should have received a copy of the gnu general public license along with .+",
    "lgpl-received": "you should have received a copy of the gnu lesser general public license along with .+",
    "agpl-received": "you should have received a copy of the gnu affero general public license along with .+",
}

# Rules in the order they are tried, as identifiers that follow one another and their licence.
RULES = [
    (["apache2-ref", "apache2-use", "apache2-copy", "apache2-basis", "apache2-see"], "Apache-2.0"),
    (["boost-grant", "boost-notice", "boost-warranty", "boost-liability"], "BSL-1.0"),
    (["zlib-warranty", "zlib-liability", "zlib-grant", "zlib-origin", "zlib-altered", "zlib-notice"], "Zlib"),
    (["bsd-grant", "bsd-source", "bsd-binary", "bsd-advert", "bsd-endorse"], "BSD-4-Clause"),
    (["asf-agreements", "apache2-asf", "apache2-copy", "apache2-basis", "apache2-see"], "Apache-2.0"),
    (["asf-agreements", "apache2-asf", "apache2-use", "apache2-copy", "apache2-basis", "apache2-see"], "Apache-2.0"),
    (["apache2-use", "apache2-copy", "apache2-basis", "apache2-see"], "Apache-2.0"),
    (["bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse"], "BSD-3-Clause"),
    (["mit-grant", "mit-notice", "mit-warranty", "mit-liability"], "MIT"),
    (["gpl3-later", "gpl-warranty", "gpl-see", "gpl-received"], "GPL-3.0-or-later"),
    (["gpl2-later", "gpl-warranty", "gpl-see", "gpl-received"], "GPL-2.0-or-later"),
    (["lgpl21-later", "lgpl-warranty", "lgpl-see", "lgpl-received"], "LGPL-2.1-or-later"),
    (["lgpl3-later", "lgpl-warranty", "lgpl-see", "lgpl-received"], "LGPL-3.0-or-later"),
    (["agpl3-later", "gpl-warranty", "agpl-see", "agpl-received"], "AGPL-3.0-or-later"),
    (["bsd-grant", "bsd-source", "bsd-binary"], "BSD-2-Clause"),
    (["mit-grant", "mit-notice"], "MIT"),
    (["mpl2-ref", "mpl2-obtain"], "MPL-2.0"),
    (["boost-title", "boost-grant"], "BSL-1.0"),
    (["boost-ref", "boost-see"], "BSL-1.0"),
    (["apache-title", "apache2-version"], "Apache-2.0"),
    (["gpl-title", "gpl3-version"], "GPL-3.0-only"),
    (["gpl-title", "gpl2-version"], "GPL-2.0-only"),
    (["apache2-asf"], "Apache-2.0"),
    (["gpl2-only", "gpl-warranty", "gpl-see", "gpl-received"], "GPL-2.0-only"),
    (["gpl3-only", "gpl-warranty", "gpl-see", "gpl-received"], "GPL-3.0-only"),
    (["gpl2-only"], "GPL-2.0-only"),
    (["gpl3-only"], "GPL-3.0-only"),
    (["bsd-style-ref"], "BSD"),
    (["apache2-ref"], "Apache-2.0"),
    (["apache2-use"], "Apache-2.0"),
    (["mit-ref"], "MIT"),
    (["isc-grant"], "ISC"),
    (["bsd-ref"], "BSD"),
    (["gpl3-later"], "GPL-3.0-or-later"),
    (["gpl2-later"], "GPL-2.0-or-later"),
    (["gpl3-ref"], "GPL-3.0-only"),
    (["gpl2-ref"], "GPL-2.0-only"),
    (["lgpl21-later"], "LGPL-2.1-or-later"),
    (["lgpl3-later"], "LGPL-3.0-or-later"),
    (["agpl3-later"], "AGPL-3.0-or-later"),
    (["lgpl21-ref"], "LGPL-2.1-only"),
    (["lgpl3-ref"], "LGPL-3.0-only"),
    (["agpl3-ref"], "AGPL-3.0-only"),
    (["mpl2-ref"], "MPL-2.0"),
    (["mpl2-obtain"], "MPL-2.0"),
    (["mit-title"], "MIT"),
    (["bsd2-title"], "BSD-2-Clause"),
    (["bsd3-title"], "BSD-3-Clause"),
    (["isc-title"], "ISC"),
    (["zlib-grant"], "Zlib"),
    (["zlib-title"], "Zlib"),
    (["boost-grant"], "BSL-1.0"),
    (["boost-ref"], "BSL-1.0"),
    (["boost-title"], "BSL-1.0"),
    (["epl2-ref"], "EPL-2.0"),
    (["epl1-ref"], "EPL-1.0"),
    (["artistic2-ref"], "Artistic-2.0"),
    (["cc-by4-ref"], "CC-BY-4.0"),
    (["cc-by-sa4-ref"], "CC-BY-SA-4.0"),
    (["cc-by-nc4-ref"], "CC-BY-NC-4.0"),
    (["cc-by-nd4-ref"], "CC-BY-ND-4.0"),
    (["cc0-ref"], "CC0-1.0"),
    (["unlicense-grant"], "Unlicense"),
    (["rights"], "All-Rights-Reserved"),
]

# Each known sentence has one of these, and so has each sentence that counts as UNKNOWN.
ANCHORS = ["licen", "permission", "copyright", "software", "redistribut", "warrant", "mpl", "cc0", "rights reserved", "source distribution", "altered source", "january 2004", "june 2007", "june 1991"]
SPOKEN = "licen[cs]e"
UNKNOWN = "UNKNOWN"

RIGHTS = "All-Rights-Reserved"

# Names that an SPDX tag may have, old names for them, and exceptions.
SPDX = ["MIT", "MIT-0", "Apache-2.0", "0BSD", "BSD-2-Clause", "BSD-3-Clause", "BSD-4-Clause", "ISC", "Zlib", "BSL-1.0", "EPL-1.0", "EPL-2.0", "MPL-2.0", "GPL-1.0-only", "GPL-1.0-or-later", "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0-only", "GPL-3.0-or-later", "LGPL-2.0-only", "LGPL-2.0-or-later", "LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0-only", "LGPL-3.0-or-later", "AGPL-3.0-only", "AGPL-3.0-or-later", "Artistic-2.0", "CC-BY-3.0", "CC-BY-SA-3.0", "CC-BY-4.0", "CC-BY-SA-4.0", "CC-BY-NC-4.0", "CC-BY-ND-4.0", "CC0-1.0", "OFL-1.1", "PSF-2.0", "WTFPL", "X11", "Unlicense"]
OLD_SPDX = {"GPL-1.0": "GPL-1.0-only", "GPL-2.0": "GPL-2.0-only", "GPL-3.0": "GPL-3.0-only", "LGPL-2.0": "LGPL-2.0-only", "LGPL-2.1": "LGPL-2.1-only", "LGPL-3.0": "LGPL-3.0-only", "AGPL-3.0": "AGPL-3.0-only"}
EXCEPTIONS = ["Autoconf-exception-3.0", "Bison-exception-2.2", "Classpath-exception-2.0", "Font-exception-2.0", "GCC-exception-3.1", "LLVM-exception", "Linux-syscall-note", "OpenSSL-exception", "Qt-LGPL-exception-1.1"]

# What is mended before sentences are cut, in order: a pattern, and what stands for it (with $1 and $2 for its groups).
MENDED = [
    (r"(?m)^[ \t]*(?://+|/\*+|\*+/|\*+|#+|--+|;+|%+)[ \t]?", ""),  # comment leaders
    (r"(?m)[ \t]*\*+/[ \t\r]*$", ""),
    (r"([0-9])\+|-or-later\b", "$1 orlater"),  # of SPDX names; "or" joins them
    (r"spdx-license-identifier:([^\n]*)", ". spdx license identifier$1. "),
    (r"\b([a-z])\. ([0-9])", "$1 $2"),  # "v. 2.0" goes on
    (r"\n[ \t\r]*\n[ \t\r]*(<?https?:)", " $1"),  # a URL in a paragraph of its own goes on with the sentence before it
]
ENDS = r"[.!?:]+[)\"']*[ \t\r\n]"
UNUSED = "|"  # stands where a rule used identifiers up

_KNOWN = {s: i for i, sentences in SENTENCES.items() for s in sentences}
_normal = lambda name: " ".join(name.lower().replace("-or-later", " orlater").replace("-", " ").replace(".", " ").split())
_LATER = {f"{_normal(name)} orlater": f"{name}+" for name in SPDX if name[-1].isdigit()}
_TAGS = {_normal(name): name for name in SPDX} | {_normal(old): new for old, new in OLD_SPDX.items()} | {f"{_normal(old)} orlater": f"{old}-or-later" for old in OLD_SPDX} | _LATER
_EXCEPTIONS = {_normal(name): name for name in EXCEPTIONS}
_TAG, _JOINED, _WITH = "spdx license identifier ", " (?:and|or) ", " with "
_ANY_TEMPLATE = "|".join(TEMPLATES.values())
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _mended(text: Column) -> Column:
    for pattern, instead in MENDED:
        text = F.regexp_replace(text, pattern.replace("(?m)", "(?md)"), instead)  # d: lines end with \n only
    return text


def _sentences(text: Column) -> Column:
    ended = F.regexp_replace(F.concat(text, F.lit("\n")), ENDS, "\n")
    return F.transform(F.split(ended, "\n"), lambda s: F.trim(F.regexp_replace(s, "[^a-z0-9]+", " ")))


def _joined_lines(text: Column) -> Column:
    paragraphs = F.regexp_replace(text, r"\n[ \t\r]*\n", ". ")
    return F.translate(paragraphs, "\n", " ")


def _map(pairs: dict[str, str]) -> Column:
    return F.create_map(*(F.lit(x) for pair in pairs.items() for x in pair))


def _tagged(name: Column) -> Column:
    """The identifier of one name in a tag's expression: its licence, and its exception after an ampersand."""
    known, exception = _map(_TAGS)[F.split_part(name, F.lit(_WITH), F.lit(1))], _map(_EXCEPTIONS)[F.split_part(name, F.lit(_WITH), F.lit(2))]
    return F.coalesce(F.concat(F.lit("spdx-"), F.lower(known), F.coalesce(F.concat(F.lit("&"), F.lower(exception)), F.lit(""))), F.lit(UNKNOWN))


def _templated(s: Column) -> Column:
    out = F.when(s.rlike(f"^(?:{next(iter(TEMPLATES.values()))})$"), F.lit(next(iter(TEMPLATES))))
    for i, pattern in list(TEMPLATES.items())[1:]:
        out = out.when(s.rlike(f"^(?:{pattern})$"), F.lit(i))
    return F.when(s.rlike(f"^(?:{_ANY_TEMPLATE})$"), out)


def _identified(sentences: Column) -> Column:
    known = _map(_KNOWN)

    def one(s: Column) -> Column:
        sentence = F.coalesce(known[s], _templated(s), F.when(s.rlike(SPOKEN), F.lit(UNKNOWN)))
        return F.when(s.startswith(_TAG), F.transform(F.split(F.substring(s, len(_TAG) + 1, 1 << 30), _JOINED), _tagged)).otherwise(F.split(sentence, " "))

    return F.flatten(F.array_compact(F.transform(F.filter(sentences, lambda s: s != ""), one)))


def _spelt_rule(ids: list[str]) -> str:
    return "".join(f"<{i}>" for i in ids)


def _spelt(ids: Column) -> Column:
    """Identifiers in brackets: a rule is found as text. UNKNOWN ones don't part a sequence."""
    return F.array_join(F.transform(F.array_remove(ids, UNKNOWN), lambda i: F.concat(F.lit("<"), i, F.lit(">"))), "")


def _matched(spelt: Column) -> Column:
    rules = F.array(*(F.struct(F.lit(_spelt_rule(ids)).alias("ids"), F.lit(name).alias("name")) for ids, name in RULES))
    start = F.struct(spelt.alias("left"), F.array().cast("array<string>").alias("names"))

    def use(so_far: Column, rule: Column) -> Column:
        used = F.struct(F.replace(so_far["left"], rule["ids"], F.lit(UNUSED)).alias("left"), F.concat(so_far["names"], F.array(rule["name"])).alias("names"))
        return F.when(F.contains(so_far["left"], rule["ids"]), used).otherwise(so_far)

    return F.aggregate(rules, start, use, lambda end: end["names"])


def _named(ids: Column) -> Column:
    """Licences of the tags among the identifiers."""
    names, exceptions = _map({n.lower(): n for n in _TAGS.values()}), _map({n.lower(): n for n in EXCEPTIONS})
    part = lambda i, n: F.split_part(F.substring(i, 6, 1 << 30), F.lit("&"), F.lit(n))
    name = lambda i: F.concat(names[part(i, 1)], F.coalesce(F.concat(F.lit(" WITH "), exceptions[part(i, 2)]), F.lit("")))
    return F.transform(F.filter(ids, lambda i: i.startswith("spdx-")), name)


def license_scan(docs: DataFrame) -> DataFrame:
    """doc_id, licenses, sentence_ids and n_unknown of every row.

    licenses: the rules' and tags' licences from either way to cut the text, each once, sorted and joined by commas. sentence_ids:
    the identifiers in order, joined by commas, UNKNOWN ones included, from the way that knows more sentences, then from
    the one with fewer UNKNOWN, then from that by lines; n_unknown counts these.
    Null and empty texts, and those without a licence sentence, have empty strings and 0. Texts of any length are read as
    a whole. Ties: of rules of equal length the earlier one is tried first. Repeated rows give repeated results. An empty
    table gives an empty result. Columns of docs other than doc_id and text, whatever their names, are not looked at.
    """
    text = F.translate(F.coalesce(F.col("text").cast("string"), F.lit("")), _UPPER, _LOWER)
    none = F.array().cast("array<string>")
    rows = docs.select("doc_id", text.alias("text"))
    rows = rows.select("doc_id", F.when(F.col("text").rlike("|".join(a.replace(" ", "[^a-z0-9]+") for a in ANCHORS)), F.col("text")).alias("text"))
    rows = rows.select("doc_id", _mended(F.col("text")).alias("text"))
    by_line = F.when(F.col("text").isNotNull(), _identified(_sentences(F.col("text")))).otherwise(none)
    wrapped = F.when(F.col("text").isNotNull(), _identified(_sentences(_joined_lines(F.col("text"))))).otherwise(none)
    rows = rows.select("doc_id", by_line.alias("by_line"), wrapped.alias("wrapped"))
    known, unknown = (lambda c: F.size(F.array_remove(c, UNKNOWN))), (lambda c: F.size(c) - F.size(F.array_remove(c, UNKNOWN)))
    better = (known("wrapped") > known("by_line")) | ((known("wrapped") == known("by_line")) & (unknown("wrapped") < unknown("by_line")))
    ids = F.when(better, F.col("wrapped")).otherwise(F.col("by_line"))
    tags = lambda c: _named(F.col(c))
    names = F.array_union(F.array_union(_matched(_spelt(F.col("by_line"))), _matched(_spelt(F.col("wrapped")))), F.array_union(tags("by_line"), tags("wrapped")))
    names = F.when(F.size("by_line") + F.size("wrapped") > 0, names).otherwise(none)
    rows = rows.select("doc_id", names.alias("names"), ids.alias("ids"))
    ids = F.col("ids")
    misleading = (F.size("names") == 1) & (unknown(ids) > 0)
    return rows.select(
        "doc_id",
        F.array_join(F.array_sort(F.when(misleading, F.array_remove("names", RIGHTS)).otherwise(F.col("names"))), ",").alias("licenses"),
        F.array_join(ids, ",").alias("sentence_ids"),
        unknown(ids).cast("long").alias("n_unknown"),
    )


def _quoted(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


def sql() -> str:
    """The same in DuckDB SQL, from the same tables."""
    keys, values = (f"[{', '.join(map(_quoted, x))}]" for x in (_KNOWN.keys(), _KNOWN.values()))
    quote = lambda x: _quoted(x).replace("\n", "' || chr(10) || '")
    mended = "CASE WHEN regexp_matches(t, " + _quoted("|".join(a.replace(" ", "[^a-z0-9]+") for a in ANCHORS)) + ") THEN t ELSE '' END"
    for pattern, instead in MENDED:
        mended = f"regexp_replace({mended}, {_quoted(pattern)}, {quote(instead.replace('$1', '\\1').replace('$2', '\\2'))}, 'g')"
    cut = lambda t: f"list_transform(string_split(regexp_replace({t} || chr(10), {_quoted(ENDS)}, chr(10), 'g'), chr(10)), lambda s: trim(regexp_replace(s, '[^a-z0-9]+', ' ', 'g')))"
    wrapped = "replace(regexp_replace(t, '\\n[ \\t\\r]*\\n', '. ', 'g'), chr(10), ' ')"
    of = lambda pairs, x: f"([{', '.join(map(_quoted, pairs.values()))}])[list_position([{', '.join(map(_quoted, pairs))}], {x})]"
    templates = " ".join(f"WHEN regexp_full_match(s, {_quoted(pattern)}) THEN {_quoted(i)}" for i, pattern in TEMPLATES.items())
    tagged = f"coalesce('spdx-' || lower({of(_TAGS, f'split_part(x, {_quoted(_WITH)}, 1)')}) || coalesce('&' || lower({of(_EXCEPTIONS, f'split_part(x, {_quoted(_WITH)}, 2)')}), ''), '{UNKNOWN}')"
    tags = f"list_transform(string_split_regex(substr(s, {len(_TAG) + 1}), {_quoted(_JOINED)}), lambda x: {tagged})"
    plain = f"string_split(coalesce(({values})[list_position({keys}, s)], CASE {templates} WHEN regexp_matches(s, '{SPOKEN}') THEN '{UNKNOWN}' END), ' ')"
    named = lambda c: f"flatten(list_filter(list_transform(list_filter({c}, lambda s: s <> ''), lambda s: CASE WHEN starts_with(s, {_quoted(_TAG)}) THEN {tags} ELSE {plain} END), lambda i: i IS NOT NULL))"
    back = lambda i, n: f"split_part(substr({i}, 6), '&', {n})"
    names = lambda c: f"list_transform(list_filter({c}, lambda i: starts_with(i, 'spdx-')), lambda i: {of({n.lower(): n for n in _TAGS.values()}, back('i', 1))} || coalesce(' WITH ' || {of({n.lower(): n for n in EXCEPTIONS}, back('i', 2))}, ''))"
    spelt = lambda c: f"coalesce(list_aggregate(list_transform(list_filter({c}, lambda i: i <> '{UNKNOWN}'), lambda i: '<' || i || '>'), 'string_agg', ''), '')"
    steps = [
        f"l AS (SELECT doc_id, translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}') AS t FROM documents)",
        f"d AS (SELECT doc_id, {mended} AS t FROM l)",
        f"c AS (SELECT doc_id, {named(cut('t'))} AS a, {named(cut(wrapped))} AS b FROM d)",
        f"k AS (SELECT *, len(list_filter(a, lambda i: i <> '{UNKNOWN}')) AS ka, len(list_filter(b, lambda i: i <> '{UNKNOWN}')) AS kb FROM c)",
        f"m0 AS (SELECT doc_id, CASE WHEN kb > ka OR (kb = ka AND len(b) < len(a)) THEN b ELSE a END AS a, {spelt('a')} AS x, {names('a')} AS xs, {spelt('b')} AS y, {names('b')} AS ys FROM k)",
    ]
    for n, (ids, name) in enumerate(RULES):
        rule = _quoted(_spelt_rule(ids))
        used = ", ".join(f"CASE WHEN contains({v}, {rule}) THEN replace({v}, {rule}, '{UNUSED}') ELSE {v} END AS {v}, CASE WHEN contains({v}, {rule}) THEN list_append({v}s, {_quoted(name)}) ELSE {v}s END AS {v}s" for v in "xy")
        steps.append(f"m{n + 1} AS MATERIALIZED (SELECT doc_id, a, {used} FROM m{n})")
    return f"""WITH {', '.join(steps)}
        SELECT doc_id, coalesce(array_to_string(list_sort(list_filter(names, lambda n: n <> '{RIGHTS}' OR len(names) > 1 OR n_unknown = 0)), ','), '') AS licenses,
               coalesce(array_to_string(a, ','), '') AS sentence_ids, n_unknown
        FROM (SELECT doc_id, a, list_distinct(xs || ys) AS names, len(list_filter(a, lambda i: i = '{UNKNOWN}'))::BIGINT AS n_unknown FROM m{len(RULES)})"""
