"""Signature rules for licence statements, written by hand.

A rule is a line ``label | keywords | pattern``. Patterns match words in lower case with one space
between them: a word is a run of ASCII letters and digits and of other characters, so ``GPL-3.0`` reads
``gpl 3 0``. A rule is tried only on texts that hold all its keywords. Order within a level
decides between equal stretches, so the special rules stand before the general ones.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

#: The phrases whose places are always reported, with their labels.
BASE = """
cc-by | cc by | cc by
gpl | general public license | general public license
reserved | all rights reserved | all rights reserved
"""

#: Sentences that grant or refuse, as licences and notices word them.
GRANTS = r"""
mit | permission granted | permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files
mit | permission granted | permission is hereby granted free of charge to any person obtaining a copy
mit | merchantability noninfringement | the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement
mit | copyright permission notice | the above copyright notice and this permission notice (?:\(including the next paragraph\) )?shall be included in all copies or substantial portions of the software
mit | under mit | (?:released|licensed|distributed|available|published) under (?:the )?(?:terms of the )?mit licen[cs]e
mit-0 | permission modify | permission is hereby granted free of charge (?:\S+ ){8,20}to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so the software is provided
isc | permission use | permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted
isc | disclaims warranties regard | the software is provided as is and (?:the )?(?:author|isc|\S+) disclaims all warranties with regard to this software
0bsd | permission use | permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted the software
bsd-2-clause | redistribution source binary | redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met
bsd-3-clause | endorse promote | neither the names? of (?:\S+ ){1,12}may be used to endorse or promote products derived from this software
bsd-4-clause | advertising materials | all advertising materials mentioning features or use of this software must display the following acknowledge?ment
bsd | redistributions retain | redistributions of source code must retain the (?:above )?copyright notice
bsd | redistributions reproduce | redistributions in binary form must reproduce the (?:above )?copyright notice
bsd | under bsd | (?:released|licensed|distributed|available) under (?:the |a )?(?:terms of the )?(?:\S+ ){0,3}bsd (?:style )?licen[cs]e
apache-2.0 | licensed apache | licensed under the apache licen[cs]e version 2(?: 0)?
apache-2.0 | apache obtain | you may not use this file except in compliance with the licen[cs]e you may obtain a copy of the licen[cs]e at http www apache org
apache-2.0 | applicable distributed writing | unless required by applicable law or agreed to in writing software distributed under the licen[cs]e is distributed on an as is basis
apache-1.1 | product apache | this product includes software developed by the apache (?:software foundation|group)
gpl-3.0 | gnu general | (?:this work|this program|it) is licensed under the gnu general public licen[cs]e version 3(?: 0)?
gpl-2.0 | gnu general | (?:this work|this program|it) is licensed under the gnu general public licen[cs]e version 2(?: 0)?
gpl-3.0-or-later | redistribute gnu later | redistribute it and or modify it under the terms of the gnu general public licen[cs]e as published by the free software foundation either version 3 of the licen[cs]e or (?:at your option )?any later version
gpl-2.0-or-later | redistribute gnu later | redistribute it and or modify it under the terms of the gnu general public licen[cs]e as published by the free software foundation either version 2 of the licen[cs]e or (?:at your option )?any later version
gpl-1.0-or-later | redistribute gnu later | redistribute it and or modify it under the terms of the gnu general public licen[cs]e as published by the free software foundation either version 1 or (?:at your option )?any later version
gpl-3.0-only | gnu published foundation | under the terms of (?:version 3 of the gnu general public licen[cs]e|the gnu general public licen[cs]e version 3) as published by the free software foundation
gpl-2.0-only | gnu published foundation | under the terms of (?:version 2 of the gnu general public licen[cs]e|the gnu general public licen[cs]e version 2) as published by the free software foundation
gpl | gnu received | you should have received a copy of the gnu general public licen[cs]e
gpl | gnu details | see the gnu general public licen[cs]e for more details
gpl | warranty merchantability | without any warranty without even the implied warranty of merchantability or fitness for a particular purpose
lgpl-2.1-or-later | redistribute lesser later | redistribute it and or modify it under the terms of the gnu lesser general public licen[cs]e as published by the free software foundation either version 2 1 of the licen[cs]e or (?:at your option )?any later version
lgpl-3.0-or-later | redistribute lesser later | redistribute it and or modify it under the terms of the gnu lesser general public licen[cs]e as published by the free software foundation either version 3 of the licen[cs]e or (?:at your option )?any later version
lgpl-2.0-or-later | redistribute library later | redistribute it and or modify it under the terms of the gnu library general public licen[cs]e as published by the free software foundation either version 2 of the licen[cs]e or (?:at your option )?any later version
lgpl | lesser received | you should have received a copy of the gnu lesser general public licen[cs]e
agpl-3.0-or-later | affero later | under the terms of the gnu affero general public licen[cs]e as published by the free software foundation either version 3 of the licen[cs]e or (?:at your option )?any later version
agpl-3.0 | affero received | you should have received a copy of the gnu affero general public licen[cs]e
gfdl | permission documentation | permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation licen[cs]e
mpl-2.0 | mozilla subject | this source code form is subject to the terms of the mozilla public licen[cs]e v(?:ersion)? ?2 0
mpl-1.1 | contents mozilla | the contents of this file are subject to the mozilla public licen[cs]e version 1 1
epl-2.0 | under eclipse terms | (?:made available|licensed) under the terms of the eclipse public licen[cs]e (?:v(?:ersion)? ?)?2 0
epl-1.0 | under eclipse terms | (?:made available|licensed) under the terms of the eclipse public licen[cs]e (?:v(?:ersion)? ?)?1 0
cddl-1.0 | common development distribution | the contents of this file are subject to the terms of the common development and distribution licen[cs]e
zlib | freely permission anyone | permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely
zlib | origin misrepresented | the origin of this software must not be misrepresented
unlicense | unencumbered domain | this is free and unencumbered software released into the public domain
wtfpl | want do | do what the f\S* you want to(?: public licen[cs]e)?
beer-ware | whatever retain stuff | as long as you retain this notice you can do whatever you want with this stuff
bsl-1.0 | boost software | distributed under the boost software licen[cs]e version 1 0
artistic-2.0 | artistic under | (?:licensed|distributed?|modify it) under the (?:terms of the )?artistic licen[cs]e (?:version )?2(?: 0)?
perl | perl itself | (?:redistribute it and or modify it )?under the same terms as perl(?: 5)? itself
ofl-1.1 | font sil | this font software is licensed under the sil open font licen[cs]e version 1 1
cc0-1.0 | waived all | has waived all (?:copyright|of (?:his|her|their|its) rights)
cc0-1.0 | dedicated domain waiving | has dedicated the work to the public domain by waiving all (?:copyright|of (?:his|her|their|its) rights)
cc-by-sa-4.0 | licensed attribution sharealike | (?:is )?licensed under (?:a |the )?(?:creative commons )?attribution sharealike 4 0(?: international)?(?: licen[cs]e)?
cc-by-sa-3.0 | licensed attribution sharealike | (?:is )?licensed under (?:a |the )?(?:creative commons )?attribution sharealike 3 0(?: \S+)?(?: licen[cs]e)?
cc-by-4.0 | licensed attribution | (?:is )?licensed under (?:a |the )?creative commons attribution 4 0(?: international)?(?: licen[cs]e)?
cc-by-3.0 | licensed attribution | (?:is )?licensed under (?:a |the )?creative commons attribution 3 0(?: \S+)?(?: licen[cs]e)?
odbl-1.0 | database open | (?:made )?available under the open database licen[cs]e
ogl-uk-3.0 | contains sector | contains public sector information licensed under the open government licen[cs]e(?: v3 0)?
openrail | restrictions referenced | use based restrictions as referenced in paragraph 5
sspl-1.0 | server side | under the terms of the server side public licen[cs]e version 1
busl-1.1 | business source | (?:governed by|use of this software is governed by) the business source licen[cs]e
elastic-2.0 | elastic the | (?:you may not use this file except in compliance with|licensed under) the elastic licen[cs]e(?: 2 0)?
reserved | part may be | no part of this (?:publication|book|work|site|document) may be (?:reproduced|copied|stored|used)
reserved | is prohibited | (?:any )?(?:unauthori[sz]ed )?(?:reproduction|copying|duplication|redistribution)(?: \S+){0,8} is (?:strictly )?prohibited
reserved | prior written | without (?:the )?(?:express )?prior written (?:permission|consent)
proprietary | confidential proprietary | (?:proprietary and confidential|confidential and proprietary)
proprietary | contains | contains (?:confidential|trade secret|proprietary) (?:\S+ ){0,4}(?:information|material|secrets?)
non-commercial | personal commercial | for personal (?:and )?non commercial use only
non-commercial | commercial | (?:not for|no) commercial use
research-only | research only | for (?:academic |non commercial )?research (?:purposes )?only
public-domain | public domain | (?:dedicated|released|placed|released in|is) (?:to |into |in )?the public domain
"""

#: Names, with versions before names without.
NAMES = r"""
cc-by-nc-nd-4.0 | cc nc nd | cc by nc nd 4 0
cc-by-nc-nd-3.0 | cc nc nd | cc by nc nd 3 0
cc-by-nc-nd-2.5 | cc nc nd | cc by nc nd 2 5
cc-by-nc-nd-2.0 | cc nc nd | cc by nc nd 2 0
cc-by-nc-sa-4.0 | cc nc sa | cc by nc sa 4 0
cc-by-nc-sa-3.0 | cc nc sa | cc by nc sa 3 0
cc-by-nc-sa-2.5 | cc nc sa | cc by nc sa 2 5
cc-by-nc-sa-2.0 | cc nc sa | cc by nc sa 2 0
cc-by-nc-4.0 | cc nc | cc by nc 4 0
cc-by-nc-3.0 | cc nc | cc by nc 3 0
cc-by-nc-2.5 | cc nc | cc by nc 2 5
cc-by-nc-2.0 | cc nc | cc by nc 2 0
cc-by-nd-4.0 | cc nd | cc by nd 4 0
cc-by-nd-3.0 | cc nd | cc by nd 3 0
cc-by-sa-4.0 | cc sa | cc by sa 4 0
cc-by-sa-3.0 | cc sa | cc by sa 3 0
cc-by-sa-2.5 | cc sa | cc by sa 2 5
cc-by-sa-2.0 | cc sa | cc by sa 2 0
cc-by-4.0 | cc by | cc by 4 0
cc-by-3.0 | cc by | cc by 3 0
cc-by-2.5 | cc by | cc by 2 5
cc-by-2.0 | cc by | cc by 2 0
cc0-1.0 | cc0 | cc0(?: 1 0)?(?: universal)?
cc0-1.0 | cc zero | cc zero(?: 1 0)?
cc-by-nc-nd | cc nc nd | cc by nc nd
cc-by-nc-sa | cc nc sa | cc by nc sa
cc-by-nc | cc nc | cc by nc
cc-by-nd | cc nd | cc by nd
cc-by-sa | cc sa | cc by sa
cc-by-nc-nd-4.0 | attribution noncommercial noderivatives | (?:creative commons )?attribution noncommercial noderivatives 4 0(?: international)?
cc-by-nc-sa-4.0 | attribution noncommercial sharealike | (?:creative commons )?attribution noncommercial sharealike 4 0(?: international)?
cc-by-nc-4.0 | attribution noncommercial | (?:creative commons )?attribution noncommercial 4 0(?: international)?
cc-by-nd-4.0 | attribution noderivatives | (?:creative commons )?attribution noderivatives 4 0(?: international)?
cc-by-sa-4.0 | attribution sharealike | (?:creative commons )?attribution sharealike 4 0(?: international)?
cc-by-4.0 | creative attribution | creative commons attribution 4 0(?: international)?
cc-by-nc-nd | attribution | (?:creative commons )?attribution non ?commercial no ?deriv(?:ative)?s?(?: works)?
cc-by-nc-sa | attribution | (?:creative commons )?attribution non ?commercial share ?alike
cc-by-nc | attribution | creative commons attribution non ?commercial
cc-by-nd | attribution | creative commons attribution no ?deriv(?:ative)?s?(?: works)?
cc-by-sa | attribution | creative commons attribution share ?alike
cc-by | creative attribution | creative commons attribution(?: licen[cs]e)?
cc-by-nc-nd-4.0 | creativecommons nc | creativecommons org licenses by nc nd 4 0
cc-by-nc-sa-4.0 | creativecommons nc | creativecommons org licenses by nc sa 4 0
cc-by-nc-sa-3.0 | creativecommons nc | creativecommons org licenses by nc sa 3 0
cc-by-nc-4.0 | creativecommons nc | creativecommons org licenses by nc 4 0
cc-by-nd-4.0 | creativecommons nd | creativecommons org licenses by nd 4 0
cc-by-sa-4.0 | creativecommons sa | creativecommons org licenses by sa 4 0
cc-by-sa-3.0 | creativecommons sa | creativecommons org licenses by sa 3 0
cc-by-4.0 | creativecommons by | creativecommons org licenses by 4 0
cc-by-3.0 | creativecommons by | creativecommons org licenses by 3 0
cc0-1.0 | creativecommons zero | creativecommons org publicdomain zero 1 0
public-domain-mark | creativecommons mark | creativecommons org publicdomain mark 1 0
mit-0 | mit | mit (?:0|no attribution)(?: licen[cs]e)?
mit | mit license | mit license
mit | mit licence | mit licence
mit | mit x11 | mit x11(?: licen[cs]e)?
mit | expat | expat licen[cs]e
mit | opensource mit | opensource org licenses mit
mit | spdx mit | spdx license identifier mit
x11 | x11 | x11 licen[cs]e
isc | isc | isc licen[cs]e
0bsd | 0bsd | 0bsd
0bsd | bsd zero | (?:bsd zero clause|zero clause bsd)(?: licen[cs]e)?
bsd-4-clause | bsd | (?:bsd 4 clause|4 clause bsd|original bsd|four clause bsd)(?: licen[cs]e)?
bsd-3-clause | bsd | (?:bsd 3 clause|3 clause bsd|new bsd|revised bsd|modified bsd|three clause bsd)(?: licen[cs]e)?
bsd-2-clause | bsd | (?:bsd 2 clause|2 clause bsd|simplified bsd|two clause bsd)(?: licen[cs]e)?
bsd-2-clause | freebsd | freebsd licen[cs]e
bsd-2-clause-patent | bsd patent | bsd 2 clause (?:plus )?patent(?: licen[cs]e)?
bsd-3-clause | spdx bsd | spdx license identifier bsd 3 clause
bsd-2-clause | spdx bsd | spdx license identifier bsd 2 clause
bsd | bsd | bsd (?:style )?licen[cs]e
apache-2.0 | apache | apache(?: software)? licen[cs]e v(?:ersion)? ?2(?: 0)?
apache-2.0 | apache | apache(?: licen[cs]e)? 2(?: 0)?
apache-2.0 | apache licenses | apache org licenses license 2 0
apache-2.0 | spdx apache | spdx license identifier apache 2 0
apache-1.1 | apache | apache(?: software)? licen[cs]e (?:version )?1 1
apache-1.0 | apache | apache(?: software)? licen[cs]e (?:version )?1 0
apache | apache | apache(?: software)? licen[cs]e
apache | asl | asl 2 0
agpl-3.0-or-later | agpl | agpl v?3(?: 0)? or later
agpl-3.0-only | agpl | agpl v?3(?: 0)? only
agpl-3.0 | agpl | agpl v?3(?: 0)?
agpl-3.0-or-later | agplv3 | agplv3(?: 0)? or (?:any )?later
agpl-3.0 | agplv3 | agplv3(?: 0)?
agpl-3.0 | affero | (?:gnu )?affero general public licen[cs]e v(?:ersion)? ?3(?: 0)?
agpl-1.0 | affero | affero general public licen[cs]e v(?:ersion)? ?1(?: 0)?
agpl | affero | (?:gnu )?affero general public licen[cs]e
agpl | agpl | (?:gnu )?agpl
lgpl-3.0-or-later | lgpl | lgpl v?3(?: 0)? or later
lgpl-3.0-only | lgpl | lgpl v?3(?: 0)? only
lgpl-3.0 | lgpl | lgpl v?3(?: 0)?
lgpl-3.0-or-later | lgplv3 | lgplv3(?: 0)? or (?:any )?later
lgpl-3.0 | lgplv3 | lgplv3(?: 0)?
lgpl-2.1 | lgplv2 | lgplv2(?: 1)?
lgpl-2.1-or-later | lgpl | lgpl v?2 1 or later
lgpl-2.1-only | lgpl | lgpl v?2 1 only
lgpl-2.1 | lgpl | lgpl v?2 1
lgpl-2.0 | lgpl | lgpl v?2(?: 0)?
lgpl-3.0 | lesser | (?:gnu )?lesser general public licen[cs]e v(?:ersion)? ?3(?: 0)?
lgpl-2.1 | lesser | (?:gnu )?lesser general public licen[cs]e v(?:ersion)? ?2 1
lgpl-2.0 | library public | (?:gnu )?library general public licen[cs]e v(?:ersion)? ?2(?: 0)?
lgpl | lesser | (?:gnu )?lesser general public licen[cs]e
lgpl | library public | (?:gnu )?library general public licen[cs]e
lgpl | lgpl | (?:gnu )?lgpl
gpl-3.0-or-later | gpl | gpl v?3(?: 0)? or later
gpl-3.0-or-later | gpl | gpl v?3 (?:any later|plus)
gpl-3.0-only | gpl | gpl v?3(?: 0)? only
gpl-2.0-or-later | gpl | gpl v?2(?: 0)? or later
gpl-2.0-or-later | gpl | gpl v?2 (?:any later|plus)
gpl-2.0-only | gpl | gpl v?2(?: 0)? only
gpl-2.0-classpath | gpl classpath | gpl v?2(?: 0)? with (?:the )?classpath exception
gpl-3.0 | gpl | (?:gnu )?gpl (?:version )?v?3(?: 0)?
gpl-2.0 | gpl | (?:gnu )?gpl (?:version )?v?2(?: 0)?
gpl-3.0-or-later | gplv3 | (?:gnu )?gplv3(?: 0)? or (?:any )?later
gpl-3.0 | gplv3 | (?:gnu )?gplv3(?: 0)?
gpl-2.0-or-later | gplv2 | (?:gnu )?gplv2(?: 0)? or (?:any )?later
gpl-2.0 | gplv2 | (?:gnu )?gplv2(?: 0)?
gpl-3.0-or-later | general later | (?:gnu )?general public licen[cs]e v(?:ersion)? ?3(?: 0)? or (?:at your option )?(?:any )?later
gpl-2.0-or-later | general later | (?:gnu )?general public licen[cs]e v(?:ersion)? ?2(?: 0)? or (?:at your option )?(?:any )?later
gpl-3.0 | general public | (?:gnu )?general public licen[cs]e v(?:ersion)? ?3(?: 0)?
gpl-2.0 | general public | (?:gnu )?general public licen[cs]e v(?:ersion)? ?2(?: 0)?
gpl-1.0 | general public | (?:gnu )?general public licen[cs]e v(?:ersion)? ?1(?: 0)?
gpl | gnu general | gnu general public licen[cs]e
gpl | gpl | (?:gnu )?gpl
gfdl-1.3 | documentation | (?:gnu )?free documentation licen[cs]e v(?:ersion)? ?1 3
gfdl-1.2 | documentation | (?:gnu )?free documentation licen[cs]e v(?:ersion)? ?1 2
gfdl-1.1 | documentation | (?:gnu )?free documentation licen[cs]e v(?:ersion)? ?1 1
gfdl | documentation free | (?:gnu )?free documentation licen[cs]e
gfdl | gfdl | (?:gnu )?gfdl(?: 1 [123])?
mpl-2.0 | mozilla | mozilla public licen[cs]e v?(?:ersion)? ?2 0
mpl-1.1 | mozilla | mozilla public licen[cs]e v?(?:ersion)? ?1 1
mpl-1.0 | mozilla | mozilla public licen[cs]e v?(?:ersion)? ?1 0
mpl-2.0 | mpl | mpl v?2 0
mpl-1.1 | mpl | mpl v?1 1
mpl | mozilla public | mozilla public licen[cs]e
npl-1.1 | netscape public | netscape public licen[cs]e(?: version)?(?: 1 1)?
epl-2.0 | eclipse | eclipse public licen[cs]e (?:v(?:ersion)? ?)?2 0
epl-1.0 | eclipse | eclipse public licen[cs]e (?:v(?:ersion)? ?)?1 0
epl | eclipse public | eclipse public licen[cs]e
epl-2.0 | epl | epl v?2 0
epl-1.0 | epl | epl v?1 0
cpl-1.0 | common public | common public licen[cs]e(?: version)?(?: 1 0)?
cddl-1.1 | cddl | cddl(?: version)? 1 1
cddl-1.0 | cddl | cddl(?: version)?(?: 1 0)?
cddl-1.0 | development distribution | common development and distribution licen[cs]e(?: version)?(?: 1 0)?
eupl-1.2 | eupl | eupl v?1 2
eupl-1.1 | eupl | eupl v?1 1
eupl-1.2 | european union | european union public licen[cs]e(?: v)?(?: 1 2)?
cecill-2.1 | cecill | cecill(?: v(?:ersion)?)? 2 1
cecill-b | cecill | cecill b
cecill-c | cecill | cecill c
cecill | cecill | cecill(?: licen[cs]e)?
zlib | zlib | zlib (?:libpng )?licen[cs]e
libpng | libpng | libpng licen[cs]e
unlicense | unlicense | (?:the )?unlicense
unlicense | unlicense org | unlicense org
wtfpl | wtfpl | wtfpl
beer-ware | beer ware | beer ware licen[cs]e
beer-ware | beerware | beerware licen[cs]e
bsl-1.0 | boost | boost software licen[cs]e
bsl-1.0 | bsl | bsl 1 0
artistic-2.0 | artistic | artistic licen[cs]e (?:version )?2(?: 0)?
artistic-1.0 | artistic | artistic licen[cs]e (?:version )?1(?: 0)?
artistic | artistic | artistic licen[cs]e
python-2.0 | python foundation | python software foundation licen[cs]e(?: version 2)?
python-2.0 | psf | psf licen[cs]e
ruby | ruby | ruby licen[cs]e
php-3.01 | php | php licen[cs]e(?: version)?(?: 3 0?1)?
ncsa | illinois | university of illinois ncsa(?: open source)? licen[cs]e
ncsa | ncsa | ncsa licen[cs]e
ms-pl | microsoft public | microsoft public licen[cs]e
ms-pl | ms pl | ms pl
ms-rl | microsoft reciprocal | microsoft reciprocal licen[cs]e
postgresql | postgresql | postgresql licen[cs]e
openssl | openssl | openssl licen[cs]e
vim | vim | vim licen[cs]e
ofl-1.1 | sil font | sil open font licen[cs]e(?: version)?(?: 1 1)?
ofl-1.1 | ofl | ofl(?: 1 1)
afl-3.0 | academic free | academic free licen[cs]e(?: v(?:ersion)?)?(?: 3 0)?
osl-3.0 | open software | open software licen[cs]e(?: v(?:ersion)?)?(?: 3 0)?
qpl-1.0 | q public | q public licen[cs]e
apsl-2.0 | apple public | apple public source licen[cs]e
ipl-1.0 | ibm public | ibm public licen[cs]e
lppl-1.3c | latex project | latex project public licen[cs]e
json | json | json licen[cs]e
json | good evil | the software shall be used for good not evil
upl-1.0 | universal permissive | universal permissive licen[cs]e
blueoak-1.0.0 | blue oak | blue oak model licen[cs]e
mulan-psl-2.0 | mulan | mulan (?:psl|permissive software licen[cs]e)(?: v(?:ersion)?)?(?: ?2)?
sspl-1.0 | sspl | sspl(?: 1 0| v1)?
sspl-1.0 | server side | server side public licen[cs]e
busl-1.1 | busl | busl(?: 1 1)?
busl-1.1 | business source | business source licen[cs]e(?: 1 1)?
elastic-2.0 | elastic | elastic licen[cs]e(?: v?2(?: 0)?)?
commons-clause | commons clause | commons clause
polyform | polyform | polyform (?:noncommercial|shield|small business|strict|perimeter)(?: licen[cs]e)?
odbl-1.0 | odbl | odbl(?: 1 0)?
odbl-1.0 | database open | open (?:data commons open )?database licen[cs]e
odc-by-1.0 | odc by | odc by(?: 1 0)?
odc-by-1.0 | commons attribution | open data commons attribution(?: licen[cs]e)?
pddl-1.0 | pddl | pddl(?: 1 0)?
pddl-1.0 | domain dedication | public domain dedication and licen[cs]e
cdla-permissive-2.0 | cdla | cdla permissive(?: 2 0| 1 0)?
cdla-sharing-1.0 | cdla | cdla sharing(?: 1 0)?
ogl-uk-3.0 | government | open government licen[cs]e(?: v3 0)?
etalab-2.0 | etalab | (?:licence ouverte )?etalab(?: 2 0)?
dl-de-by-2.0 | datenlizenz | datenlizenz deutschland (?:namensnennung )?(?:version )?2 0
llama-2 | llama | llama 2 community licen[cs]e(?: agreement)?
llama-3 | llama | llama 3(?: [123])? community licen[cs]e(?: agreement)?
openrail | openrail | (?:creativeml |bigcode |bigscience )?openrail(?: m)?
gemma | gemma | gemma terms of use
etalab-2.0 | licence ouverte | licence ouverte
cc | creative commons | creative commons licen[cs]e
gfdl | gnu fdl | gnu fdl
public-domain | public domain | public domain
spdx | spdx | spdx license identifier
"""

#: What only says that some licence or right is meant.
GENERAL = r"""
licensed | licensed | (?:is |are )?licensed under (?:the |a )?(?:\S+ ){0,4}licen[cs]e
licensed | released | released under (?:the |a )?(?:\S+ ){0,4}licen[cs]e
licensed | distributed | distributed under (?:the |a )?(?:\S+ ){0,4}licen[cs]e
licensed | terms | (?:under|subject to) the terms of (?:the |this )?(?:\S+ ){0,4}licen[cs]e
licensed | licence | (?:diffusé|publié|distribué) sous licence
licensed | lizenz | (?:unter der|steht unter) (?:\S+ ){0,3}lizenz
licensed | licencia | (?:bajo|según) (?:la )?licencia
copyright | copyright | copyright (?:c )?(?:19|20)\d\d(?: (?:19|20)\d\d)?
copyright | copyright | (?:c )?copyright (?:by|held by|owned by)
copyright | copyrighted | (?:is |are )?copyrighted (?:material|work|content)
copyright | © | (?:copyright )?©(?: (?:19|20)\d\d)?
reserved | rights reserved | (?:some|all other|these) rights reserved
reserved | droits | tous droits réservés
reserved | rechte | alle rechte vorbehalten
reserved | derechos | todos los derechos reservados
reserved | diritti | tutti i diritti riservati
trademark | trademark | is a (?:registered )?trademark of
trademark | trademarks | are (?:registered )?trademarks of
eula | eula | (?:the |this )?eula
eula | agreement | end user licen[cs]e agreement
terms | terms | (?:subject to|see) (?:our |the )?terms (?:of (?:use|service)|and conditions)
permission | permission | (?:reprinted|used|reproduced) (?:with|by) (?:kind )?permission
royalty-free | royalty | royalty free
fair-use | fair | fair (?:use|dealing)
"""

#: How sure a detection of each level is.
CONFIDENCE = {3: 0.95, 2: 0.85, 1: 0.4}


@dataclass(frozen=True)
class Rule:
    order: int
    label: str
    level: int
    base: bool
    keywords: frozenset[bytes]
    pattern: re.Pattern[bytes]


def _rules(text: str, level: int, base: bool, first: int) -> list[Rule]:
    out = []
    for line in text.strip().splitlines():
        label, keywords, pattern = (part.strip().encode() for part in line.split(" | "))
        whole = re.compile(rb"(?<= )(?:" + pattern + rb")(?= )")
        out.append(Rule(first + len(out), label.decode(), level, base, frozenset(keywords.split()), whole))
    return out


def all_rules() -> list[Rule]:
    """Every rule in order: base phrases, grants, names, general ones."""
    rules: list[Rule] = []
    for text, level, base in ((BASE, 3, True), (GRANTS, 3, False), (NAMES, 2, False), (GENERAL, 1, False)):
        rules += _rules(text, level, base, len(rules))
    return rules
