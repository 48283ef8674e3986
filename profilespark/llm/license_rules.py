"""Signature rules of the license scan, written by hand.

A line is ``priority | label | keyword | expression``. The expression is searched in the text with A-Z
lower-cased, and only if the words of the text, one blank between them, hold those of the keyword.
A blank in an expression stands for any run of characters that are no letters or digits. Priorities: 100 machine-readable tags, 90 grants and
conditions, 80 names with a version, 70 addresses, 50 names, 30 hints.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

RULES = r"""
100 | apache-2.0 | spdx-license-identifier | spdx license identifier apache 2\.0\b
100 | apache-1.1 | spdx-license-identifier | spdx license identifier apache 1\.1\b
100 | mit | spdx-license-identifier | spdx license identifier mit(?![-\w])
100 | mit-0 | spdx-license-identifier | spdx license identifier mit-0\b
100 | isc | spdx-license-identifier | spdx license identifier isc\b
100 | 0bsd | spdx-license-identifier | spdx license identifier 0bsd\b
100 | bsd-1-clause | spdx-license-identifier | spdx license identifier bsd 1 clause\b
100 | bsd-2-clause | spdx-license-identifier | spdx license identifier bsd 2 clause\b
100 | bsd-3-clause | spdx-license-identifier | spdx license identifier bsd 3 clause\b
100 | bsd-4-clause | spdx-license-identifier | spdx license identifier bsd 4 clause\b
100 | gpl-2.0-only | spdx-license-identifier | spdx license identifier gpl 2\.0(?: only)?(?![-+\w])
100 | gpl-2.0-or-later | spdx-license-identifier | spdx license identifier gpl 2\.0(?:\+|-or-later)
100 | gpl-3.0-only | spdx-license-identifier | spdx license identifier gpl 3\.0(?: only)?(?![-+\w])
100 | gpl-3.0-or-later | spdx-license-identifier | spdx license identifier gpl 3\.0(?:\+|-or-later)
100 | lgpl-2.1-only | spdx-license-identifier | spdx license identifier lgpl 2\.1(?: only)?(?![-+\w])
100 | lgpl-2.1-or-later | spdx-license-identifier | spdx license identifier lgpl 2\.1(?:\+|-or-later)
100 | lgpl-3.0-only | spdx-license-identifier | spdx license identifier lgpl 3\.0(?: only)?(?![-+\w])
100 | lgpl-3.0-or-later | spdx-license-identifier | spdx license identifier lgpl 3\.0(?:\+|-or-later)
100 | agpl-3.0-only | spdx-license-identifier | spdx license identifier agpl 3\.0(?: only)?(?![-+\w])
100 | agpl-3.0-or-later | spdx-license-identifier | spdx license identifier agpl 3\.0(?:\+|-or-later)
100 | mpl-1.1 | spdx-license-identifier | spdx license identifier mpl 1\.1\b
100 | mpl-2.0 | spdx-license-identifier | spdx license identifier mpl 2\.0\b
100 | epl-1.0 | spdx-license-identifier | spdx license identifier epl 1\.0\b
100 | epl-2.0 | spdx-license-identifier | spdx license identifier epl 2\.0\b
100 | cddl-1.0 | spdx-license-identifier | spdx license identifier cddl 1\.0\b
100 | eupl-1.2 | spdx-license-identifier | spdx license identifier eupl 1\.2\b
100 | bsl-1.0 | spdx-license-identifier | spdx license identifier bsl 1\.0\b
100 | busl-1.1 | spdx-license-identifier | spdx license identifier busl 1\.1\b
100 | zlib | spdx-license-identifier | spdx license identifier zlib\b
100 | unlicense | spdx-license-identifier | spdx license identifier unlicense\b
100 | cc0-1.0 | spdx-license-identifier | spdx license identifier cc0 1\.0\b
100 | cc-by-4.0 | spdx-license-identifier | spdx license identifier cc by 4\.0\b
100 | cc-by-sa-4.0 | spdx-license-identifier | spdx license identifier cc by sa 4\.0\b
100 | ofl-1.1 | spdx-license-identifier | spdx license identifier ofl 1\.1\b
100 | artistic-2.0 | spdx-license-identifier | spdx license identifier artistic 2\.0\b
100 | wtfpl | spdx-license-identifier | spdx license identifier wtfpl\b
100 | postgresql | spdx-license-identifier | spdx license identifier postgresql\b
100 | ncsa | spdx-license-identifier | spdx license identifier ncsa\b
100 | upl-1.0 | spdx-license-identifier | spdx license identifier upl 1\.0\b
100 | ms-pl | spdx-license-identifier | spdx license identifier ms pl\b
90 | apache-2.0 | licensed under the apache license | licensed under the apache license version 2\.0
90 | apache-2.0 | you may not use this file except in compliance | you may not use this file except in compliance with the license
90 | mit | permission is hereby granted | permission is hereby granted free of charge to any person obtaining a copy
90 | mit | the above copyright notice and this permission notice | the above copyright notice and this permission notice shall be included in all copies
90 | mit | released under the mit license | released under the mit license\b
90 | mit | licensed under the mit license | licensed under the mit license\b
90 | mit | mit license | distributed under the (?:terms of the )?mit license\b
90 | mit-0 | without restriction | mit no attribution\b
90 | isc | permission to use, copy, modify, and/or distribute | permission to use copy modify and or distribute this software for any purpose with or without fee
90 | isc | permission to use, copy, modify, and distribute | permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted provided
90 | bsd-2-clause | redistribution and use in source and binary forms | redistribution and use in source and binary forms with or without modification are permitted provided
90 | bsd-3-clause | endorse or promote products | may be used to endorse or promote products derived from this software without
90 | bsd-4-clause | all advertising materials | all advertising materials mentioning features or use of this software must display
90 | gpl-2.0-or-later | either version 2 | gnu general public license as published by the free software foundation either version 2 of the license or
90 | gpl-3.0-or-later | either version 3 | gnu general public license as published by the free software foundation either version 3 of the license or
90 | gpl-2.0-only | gnu general public license version 2 only | gnu general public license version 2 only
90 | gpl-3.0-only | gnu general public license version 3 only | gnu general public license version 3 only
90 | gpl | licensed under the gnu general public license | licensed under the (?:terms of the )?gnu general public license\b
90 | gpl | gnu general public license | under the terms of (?:the )?gnu general public license\b
90 | lgpl-2.1-or-later | either version 2.1 | gnu lesser general public license as published by the free software foundation either version 2\.1 of the license or
90 | lgpl-2.0-or-later | gnu library general public license | gnu library general public license as published by the free software foundation either version 2 of the license or
90 | lgpl-3.0-or-later | gnu lesser general public license | gnu lesser general public license as published by the free software foundation either version 3 of the license or
90 | agpl-3.0-or-later | gnu affero general public license | gnu affero general public license as published by the free software foundation either version 3 of the license or
90 | gpl-classpath-exception | linking this library statically | linking this library statically or dynamically with other modules
90 | gcc-exception-3.1 | gcc runtime library exception | gcc runtime library exception
90 | mpl-2.0 | this source code form is subject to the terms | this source code form is subject to the terms of the mozilla public license v 2\.0
90 | mpl-1.1 | the contents of this file are subject to the mozilla | the contents of this file are subject to the mozilla public license version 1\.1
90 | epl-1.0 | made available under the terms of the eclipse | made available under the terms of the eclipse public license v1\.0
90 | epl-2.0 | made available under the terms of the eclipse | made available under the terms of the eclipse public license (?:v ?|version )?2\.0
90 | cddl-1.0 | subject to the terms of the common development | subject to the terms of the common development and distribution license
90 | zlib | altered source versions must be plainly marked | altered source versions must be plainly marked as such
90 | zlib | in no event will the authors be held liable | in no event will the authors be held liable for any damages arising from the use of this software
90 | bsl-1.0 | boost software license | distributed under the boost software license version 1\.0
90 | bsl-1.0 | machine-executable object code generated | machine executable object code generated by a source language processor
90 | unlicense | free and unencumbered software | this is free and unencumbered software released into the public domain
90 | wtfpl | do what the fuck you want | do what the fuck you want to public license
90 | cc0-1.0 | waived all copyright | waived all copyright and related (?:or|and) neighboring rights
90 | cc-by | licensed under a creative commons | licensed under a creative commons attribution (?:\d\.\d )?(?:international |generic |unported )?license
90 | cc-by-sa | licensed under a creative commons | licensed under a creative commons attribution share ?alike
90 | cc-by-nc | licensed under a creative commons | licensed under a creative commons attribution non ?commercial
90 | cc-by-nd | licensed under a creative commons | licensed under a creative commons attribution no ?deriv
90 | cc-by | licensed under cc by | licensed under cc by\b
90 | ofl-1.1 | this font software is licensed | this font software is licensed under the sil open font license version 1\.1
90 | openssl | openssl toolkit | this product includes software developed by the openssl project for use in the openssl toolkit
90 | ssleay | eric young | this product includes cryptographic software written by eric young
90 | php-3.01 | php license | subject to version 3\.01 of the php license
90 | php-3.0 | php license | subject to version 3\.0 of the php license
90 | postgresql | permission to use, copy, modify, and distribute this software and its documentation | permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement
90 | ncsa | developed by | university of illinois ncsa open source license
90 | json | shall be used for good | the software shall be used for good not evil
90 | beerware | beer | as long as you retain this notice you can do whatever you want with this stuff
90 | vim | vim maintainer | changes must be made available to the vim maintainer
90 | x11 | x consortium | except as contained in this notice the name of the x consortium
90 | ntp | permission to use, copy, modify, and distribute | permission to use copy modify and distribute this software and its documentation for any purpose with or without fee is hereby granted
90 | ijg | independent jpeg group | this software is based in part on the work of the independent jpeg group
90 | libpng | png reference library | png reference library is supplied as is
90 | curl | curl | permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies
90 | unicode-dfs-2016 | unicode data files | permission is hereby granted free of charge to any person obtaining a copy of the unicode data files
90 | gfdl-1.3 | gnu free documentation license | gnu free documentation license version 1\.3
90 | gfdl-1.2 | gnu free documentation license | gnu free documentation license version 1\.2
90 | gfdl-1.1 | gnu free documentation license | gnu free documentation license version 1\.1
90 | sspl-1.0 | server side public license | server side public license(?: version 1| v1)?\b
90 | elastic-2.0 | elastic license | elastic license (?:version )?2\.0
90 | commons-clause | commons clause | commons clause license condition
90 | busl-1.1 | business source license | business source license (?:version )?1\.1
90 | polyform-noncommercial-1.0.0 | polyform | polyform noncommercial license 1\.0\.0
90 | polyform-small-business-1.0.0 | polyform | polyform small business license 1\.0\.0
90 | polyform-shield-1.0.0 | polyform | polyform shield license 1\.0\.0
90 | polyform-strict-1.0.0 | polyform | polyform strict license 1\.0\.0
90 | llama-2 | llama 2 | llama 2 community license
90 | llama-3 | llama 3 | llama 3(?:\.\d)? community license
90 | gemma | gemma | gemma terms of use
90 | openrail-m | openrail | creativeml open ?rail m\b
90 | bigscience-rail-1.0 | bigscience | bigscience rail license(?: v1\.0)?
90 | proprietary | confidential and proprietary | confidential and proprietary (?:information|software)
90 | proprietary | unauthorized copying of this file | unauthorized copying of this file via any medium is strictly prohibited
80 | apache-2.0 | apache license | apache license (?:version |v ?)?2(?:\.0)?\b
80 | apache-1.1 | apache software license | apache software license (?:version |v ?)?1\.1\b
80 | apache-1.0 | apache license | apache license (?:version |v ?)?1\.0\b
80 | gpl-1.0 | general public license | gnu general public license (?:version |v ?)?1(?:\.0)?\b
80 | gpl-2.0 | general public license | gnu general public license (?:version |v ?)?2(?:\.0)?\b
80 | gpl-3.0 | general public license | gnu general public license (?:version |v ?)?3(?:\.0)?\b
80 | gpl-2.0 | gpl | \bgpl ?v?2(?:\.0)?\b
80 | gpl-3.0 | gpl | \bgpl ?v?3(?:\.0)?\b
80 | lgpl-2.0 | lgpl | \blgpl ?v?2(?:\.0)?(?!\.\d)\b
80 | lgpl-2.1 | lgpl | \blgpl ?v?2\.1\b
80 | lgpl-3.0 | lgpl | \blgpl ?v?3(?:\.0)?\b
80 | agpl-3.0 | agpl | \bagpl ?v?3(?:\.0)?\b
80 | lgpl-2.1 | lesser general public license | lesser general public license (?:version |v ?)?2\.1\b
80 | lgpl-3.0 | lesser general public license | lesser general public license (?:version |v ?)?3(?:\.0)?\b
80 | agpl-3.0 | affero general public license | affero general public license (?:version |v ?)?3(?:\.0)?\b
80 | agpl-1.0 | affero general public license | affero general public license (?:version |v ?)?1(?:\.0)?\b
80 | mpl-1.0 | mozilla public license | mozilla public license (?:version |v ?)?1\.0\b
80 | mpl-1.1 | mozilla public license | mozilla public license (?:version |v ?)?1\.1\b
80 | mpl-2.0 | mozilla public license | mozilla public license (?:version |v ?)?2\.0\b
80 | npl-1.1 | netscape public license | netscape public license (?:version |v ?)?1\.1\b
80 | epl-1.0 | eclipse public license | eclipse public license (?:version |v ?|- ?v ?)?1\.0\b
80 | epl-2.0 | eclipse public license | eclipse public license (?:version |v ?|- ?v ?)?2\.0\b
80 | cddl-1.0 | common development and distribution license | common development and distribution license (?:cddl )?(?:version |v ?)?1\.0\b
80 | cddl-1.1 | common development and distribution license | common development and distribution license (?:cddl )?(?:version |v ?)?1\.1\b
80 | cpl-1.0 | common public license | common public license (?:version |v ?)?1\.0\b
80 | ipl-1.0 | ibm public license | ibm public license (?:version |v ?)?1\.0\b
80 | eupl-1.1 | european union public licen | european union public licen[cs]e (?:version |v ?)?1\.1\b
80 | eupl-1.2 | european union public licen | european union public licen[cs]e (?:version |v ?)?1\.2\b
80 | artistic-1.0 | artistic license | artistic license (?:version |v ?)?1\.0\b
80 | artistic-2.0 | artistic license | artistic license (?:version |v ?)?2\.0\b
80 | afl-2.1 | academic free license | academic free license (?:version |v ?)?2\.1\b
80 | afl-3.0 | academic free license | academic free license (?:version |v ?)?3\.0\b
80 | osl-2.1 | open software license | open software license (?:version |v ?)?2\.1\b
80 | osl-3.0 | open software license | open software license (?:version |v ?)?3\.0\b
80 | ecl-2.0 | educational community license | educational community license (?:version |v ?)?2\.0\b
80 | apsl-2.0 | apple public source license | apple public source license (?:version |v ?)?2\.0\b
80 | python-2.0 | python software foundation license | python software foundation license (?:version |v ?)?2\b
80 | zpl-2.1 | zope public license | zope public license (?:version |v ?)?2\.1\b
80 | zpl-2.0 | zope public license | zope public license (?:version |v ?)?2\.0\b
80 | lppl-1.3c | latex project public license | latex project public license (?:version |v ?)?1\.3c?\b
80 | lppl-1.2 | latex project public license | latex project public license (?:version |v ?)?1\.2\b
80 | qpl-1.0 | q public license | q public license (?:version |v ?)?1\.0\b
80 | rpl-1.5 | reciprocal public license | reciprocal public license (?:version |v ?)?1\.5\b
80 | cecill-2.1 | cecill | cecill (?:free software license agreement )?(?:version |v ?)?2\.1\b
80 | cecill-b | cecill | \bcecill b\b
80 | cecill-c | cecill | \bcecill c\b
80 | odbl-1.0 | open database license | open database license (?:odbl )?(?:version |v ?)?1\.0\b
80 | odc-by-1.0 | open data commons attribution license | open data commons attribution license (?:version |v ?)?1\.0\b
80 | pddl-1.0 | public domain dedication and license | public domain dedication and license (?:pddl )?(?:version |v ?)?1\.0\b
80 | mulanpsl-2.0 | mulan psl | mulan psl ?v?2\b
80 | mulanpsl-1.0 | mulan psl | mulan psl ?v?1\b
80 | cc0-1.0 | cc0 | \bcc0 1\.0\b
80 | cc-by-2.0 | cc by | \bcc by 2\.0\b
80 | cc-by-2.5 | cc by | \bcc by 2\.5\b
80 | cc-by-3.0 | cc by | \bcc by 3\.0\b
80 | cc-by-4.0 | cc by | \bcc by 4\.0\b
80 | cc-by-4.0 | cc-by | \bcc by 4\.0\b
80 | cc-by-3.0 | cc-by | \bcc by 3\.0\b
80 | cc-by-sa-3.0 | cc by-sa | \bcc by sa 3\.0\b
80 | cc-by-sa-4.0 | cc by-sa | \bcc by sa 4\.0\b
80 | cc-by-sa-3.0 | cc-by-sa | \bcc by sa 3\.0\b
80 | cc-by-sa-4.0 | cc-by-sa | \bcc by sa 4\.0\b
80 | cc-by-nc-4.0 | by-nc | \bcc by nc 4\.0\b
80 | cc-by-nc-sa-4.0 | by-nc-sa | \bcc by nc sa 4\.0\b
80 | cc-by-nc-nd-4.0 | by-nc-nd | \bcc by nc nd 4\.0\b
80 | cc-by-nd-4.0 | by-nd | \bcc by nd 4\.0\b
80 | cc-by-4.0 | creative commons | creative commons attribution 4\.0\b
80 | cc-by-3.0 | creative commons | creative commons attribution 3\.0\b
80 | cc-by-sa-4.0 | creative commons | creative commons attribution share ?alike 4\.0\b
80 | cc-by-sa-3.0 | creative commons | creative commons attribution share ?alike 3\.0\b
80 | cc-by-nc-4.0 | creative commons | creative commons attribution non ?commercial 4\.0\b
80 | cc-by-nc-sa-4.0 | creative commons | creative commons attribution non ?commercial share ?alike 4\.0\b
80 | bsd-2-clause | bsd | \b(?:2 clause bsd|bsd 2 clause|simplified bsd|freebsd) licen[cs]e
80 | bsd-3-clause | bsd | \b(?:3 clause bsd|bsd 3 clause|new bsd|modified bsd|revised bsd) licen[cs]e
80 | bsd-4-clause | bsd | \b(?:4 clause bsd|bsd 4 clause|original bsd) licen[cs]e
80 | ogl-uk-2.0 | open government licence | open government licence (?:version |v ?)?2\.0\b
80 | ogl-uk-3.0 | open government licence | open government licence (?:version |v ?)?3\.0\b
80 | dl-de-by-2.0 | datenlizenz deutschland | datenlizenz deutschland namensnennung (?:version )?2\.0\b
80 | etalab-2.0 | licence ouverte | licence ouverte (?:open licence )?(?:version )?2\.0\b
80 | gfdl-1.3 | gfdl | \bgfdl ?v?1\.3\b
80 | w3c-20150513 | w3c software | w3c software and document (?:notice and )?license
80 | hippocratic-2.1 | hippocratic license | hippocratic license (?:version )?2\.1\b
80 | blueoak-1.0.0 | blue oak model license | blue oak model license (?:version )?1\.0\.0\b
80 | parity-7.0.0 | parity public license | parity public license 7\.0\.0\b
80 | upl-1.0 | universal permissive license | universal permissive license (?:\(upl\) )?(?:version |v ?)?1\.0\b
70 | apache-2.0 | apache.org/licenses | apache\.org/licenses/license-2\.0
70 | mit | opensource.org/licenses/mit | opensource\.org/licenses/mit\b
70 | bsd-3-clause | opensource.org/licenses/bsd-3-clause | opensource\.org/licenses/bsd-3-clause
70 | bsd-2-clause | opensource.org/licenses/bsd-2-clause | opensource\.org/licenses/bsd-2-clause
70 | gpl-3.0 | gnu.org/licenses | gnu\.org/licenses/gpl-3\.0
70 | gpl-2.0 | gnu.org/licenses | gnu\.org/licenses/(?:old-licenses/)?gpl-2\.0
70 | lgpl-3.0 | gnu.org/licenses | gnu\.org/licenses/lgpl-3\.0
70 | lgpl-2.1 | gnu.org/licenses | gnu\.org/licenses/(?:old-licenses/)?lgpl-2\.1
70 | agpl-3.0 | gnu.org/licenses | gnu\.org/licenses/agpl-3\.0
70 | gfdl-1.3 | gnu.org/licenses | gnu\.org/licenses/fdl-1\.3
70 | mpl-2.0 | mozilla.org/mpl/2.0 | mozilla\.org/mpl/2\.0
70 | epl-2.0 | eclipse.org/legal | eclipse\.org/legal/epl-2\.0
70 | epl-1.0 | eclipse.org/legal | eclipse\.org/legal/epl-v10
70 | cc0-1.0 | creativecommons.org | creativecommons\.org/publicdomain/zero/1\.0
70 | public-domain | creativecommons.org | creativecommons\.org/publicdomain/mark/1\.0
70 | cc-by | creativecommons.org | creativecommons\.org/licenses/by/\d\.\d
70 | cc-by-sa | creativecommons.org | creativecommons\.org/licenses/by-sa/\d\.\d
70 | cc-by-nc | creativecommons.org | creativecommons\.org/licenses/by-nc/\d\.\d
70 | cc-by-nd | creativecommons.org | creativecommons\.org/licenses/by-nd/\d\.\d
70 | cc-by-nc-sa | creativecommons.org | creativecommons\.org/licenses/by-nc-sa/\d\.\d
70 | cc-by-nc-nd | creativecommons.org | creativecommons\.org/licenses/by-nc-nd/\d\.\d
70 | unlicense | unlicense.org | \bunlicense\.org\b
70 | bsl-1.0 | boost.org/license_1_0 | boost\.org/license_1_0\.txt
70 | ofl-1.1 | scripts.sil.org/ofl | scripts\.sil\.org/ofl\b
70 | wtfpl | wtfpl.net | \bwtfpl\.net\b
70 | odbl-1.0 | opendatacommons.org | opendatacommons\.org/licenses/odbl
70 | odc-by-1.0 | opendatacommons.org | opendatacommons\.org/licenses/by
70 | pddl-1.0 | opendatacommons.org | opendatacommons\.org/licenses/pddl
70 | eupl-1.2 | joinup.ec.europa.eu | joinup\.ec\.europa\.eu/\S*eupl
50 | gpl | gnu gpl | \bgnu gpl\b
50 | lgpl | lesser general public license | gnu lesser general public license\b
50 | lgpl | library general public license | gnu library general public license\b
50 | agpl | affero general public license | (?:gnu )?affero general public license\b
50 | mpl | mozilla public license | mozilla public license\b
50 | epl | eclipse public license | eclipse public license\b
50 | cddl | common development and distribution license | common development and distribution license\b
50 | bsd | bsd license | \bbsd (?:style )?license\b
50 | isc | isc license | \bisc license\b
50 | zlib | zlib license | \bzlib(?: libpng)? license\b
50 | bsl-1.0 | boost software license | boost software license\b
50 | artistic | artistic license | artistic license\b
50 | gfdl | gnu free documentation license | gnu free documentation license\b
50 | ofl | open font license | (?:sil )?open font license\b
50 | odbl | open database license | open database license\b
50 | eupl | european union public licen | european union public licen[cs]e\b
50 | apache | apache software license | apache software license\b
50 | ms-pl | microsoft public license | microsoft public license\b
50 | ms-rl | microsoft reciprocal license | microsoft reciprocal license\b
50 | psf | python software foundation license | python software foundation license\b
50 | ruby | ruby license | \bruby license\b
50 | sleepycat | sleepycat license | \bsleepycat license\b
50 | tcl | tcl/tk license | \btcl tk license\b
50 | cc-by-sa | cc by-sa | \bcc by sa\b
50 | cc-by-nc | cc by-nc | \bcc by nc\b
50 | cc-by-nd | cc by-nd | \bcc by nd\b
50 | cc-by-sa | creative commons | creative commons attribution share ?alike\b
50 | cc-by-nc | creative commons | creative commons attribution non ?commercial\b
50 | cc-by | creative commons | creative commons attribution\b
50 | cc0-1.0 | cc0 | \bcc0\b
50 | public-domain | public domain | (?:released into|dedicated to|placed in) the public domain\b
30 | public-domain | public domain | \bpublic domain\b
30 | creative-commons | creative commons | \bcreative commons\b
30 | copyleft | copyleft | \bcopyleft\b
30 | all-rights-reserved | all rights reserved | \ball rights reserved\b
30 | copyright-notice | copyright | \bcopyright (?:\(c\)|©) ?(?:19|20)\d\d\b
30 | no-warranty | without warranty | without warranty of any kind\b
30 | no-warranty | merchantability | merchantability or fitness for a particular purpose\b
30 | license-file | see the license file | see (?:the )?license file for details\b
"""

# Phrases of whole words and their labels.
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
BASE_PRIORITY = 50

#: A character of a word, and a run of others; in lower-cased text.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]"
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Rule:
    priority: int
    label: str
    keyword: str
    pattern: re.Pattern
    base: bool = False


def base_rules() -> list[Rule]:
    return [
        Rule(BASE_PRIORITY, label, phrase, re.compile(f"(?<!{WORD})" + GAP.join(phrase.split()) + f"(?!{WORD})"), True)
        for phrase, label in BASE.items()
    ]


def signature_rules() -> list[Rule]:
    rules = []
    for line in RULES.strip().splitlines():
        priority, label, keyword, expression = (part.strip() for part in line.split("|", 3))
        # A blank before a quantifier is one optional blank, every other a gap.
        expression = re.sub(r" (?![?*])", r"[\\W_]+", expression)
        rules.append(Rule(int(priority), label, keyword, re.compile(expression)))
    return rules
