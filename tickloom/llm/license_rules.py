"""The signatures of the licence scan: label; kind; keyword; regex, over lower-case words that are joined by one space.

Written by hand. A keyword is part of every match of its regex. Kinds, in order of priority, are listed in KINDS.
"""

from __future__ import annotations

#: kind: priority (0 wins), weight. `text` is a licence's own words, `tag` an SPDX id, `notice` what puts a work under a licence.
KINDS = {"text": (0, 1.0), "tag": (0, 1.0), "notice": (1, 0.9), "address": (1, 0.8), "name": (2, 0.6)}

SIGNATURES = r"""
mit; text; permission is hereby granted free of charge; permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files
mit; text; without restriction; deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell
mit; text; copies or substantial portions; the above copyright notice and this permission notice (?:shall|must) be included in all copies or substantial portions of the software
mit; tag; spdx; spdx licen[cs]e identifier mit
mit; notice; mit licen; (?:licensed|released|distributed|available|published|provided) under (?:the )?(?:terms of the )?mit licen[cs]e
mit; notice; licen; licen[cs]e (?:is )?mit
mit; address; opensource org; opensource org licenses? mit
mit; name; mit licen; mit licen[cs]e
mit; name; mit x11 licen; mit x11 licen[cs]e
mit; name; expat; expat licen[cs]e
mit-0; tag; spdx; spdx licen[cs]e identifier mit 0
mit-0; name; mit no attribution; mit no attribution(?: licen[cs]e)?
apache; text; apache license version 2 0 january 2004; apache license version 2 0 january 2004
apache; text; compliance with the license; you may not use this file except in compliance with the license
apache; text; perpetual worldwide non exclusive; each contributor hereby grants to you a perpetual worldwide non exclusive no charge royalty free irrevocable (?:copyright|patent) license
apache; tag; spdx; spdx licen[cs]e identifier apache (?:1 [01]|2 0)
apache; notice; apache; (?:licensed|released|distributed|available|published|provided) under (?:the )?(?:terms of the )?apache (?:software )?licen[cs]e(?: version)?(?: (?:1 [01]|2(?: 0)?))?
apache; notice; licen; licen[cs]e (?:is )?apache(?: (?:1 [01]|2(?: 0)?))?
apache; notice; software foundation; licensed to the apache software foundation asf under one or more contributor license agreements
apache; address; apache org; apache org licenses(?: license 2 0)?
apache; name; apache; apache (?:software )?licen[cs]e(?: version)?(?: (?:1 [01]|2(?: 0)?))?
apache; name; apache; apache (?:1 [01]|2 0)
gpl; text; free software you can redistribute it; free software you can redistribute it and or modify it under the terms of the gnu general public license
gpl; text; without even the implied warranty; without any warranty without even the implied warranty of merchantability or fitness for a particular purpose see the gnu general public license
gpl; text; you should have received a copy; you should have received a copy of the gnu general public license
gpl; text; verbatim copies of this license; gnu general public license version [123] .{0,80}everyone is permitted to copy and distribute verbatim copies of this license
gpl; tag; spdx; spdx licen[cs]e identifier gpl [123](?: 0)?(?: only| or later)?
gpl; notice; general public licen; (?:licensed|released|distributed|available|published|provided) under (?:the )?(?:terms of the )?(?:gnu )?general public licen[cs]e(?: (?:version )?v?[123])?
gpl; notice; gpl; (?:licensed|released|distributed|available|published|provided|subject to the terms) (?:under|of) (?:the )?(?:terms of the )?(?:gnu )?gpl(?: ?(?:version )?v?[123])?
gpl; notice; licen; licen[cs]e (?:is )?gpl(?: ?v?[123])?
gpl; address; gnu org; gnu org licenses? (?:old licenses )?gpl(?: [123] 0)?
gpl; name; general public licen; (?:gnu )?general public licen[cs]e(?: (?:version )?v?[123](?: 0)?)?(?: only| or (?:any )?later)?
gpl; name; gpl; (?:gnu )?gpl ?v?[123](?: 0)?(?: only| or later)?
gpl; name; gpl; (?:gnu )?gpl
lgpl; text; you should have received a copy; you should have received a copy of the gnu (?:lesser|library) general public license
lgpl; text; lesser general public license; redistribute it and or modify it under the terms of the gnu lesser general public license
lgpl; tag; spdx; spdx licen[cs]e identifier lgpl (?:2|2 1|3)(?: 0)?(?: only| or later)?
lgpl; address; gnu org; gnu org licenses? (?:old licenses )?lgpl(?: [23] [01])?
lgpl; name; general public licen; (?:gnu )?(?:lesser|library) general public licen[cs]e(?: (?:version )?(?:2 1|2|3))?
lgpl; name; lgpl; (?:gnu )?lgpl ?v?(?:2 1|2|3)?
agpl; text; affero general public license; under the terms of the gnu affero general public license as published by the free software foundation
agpl; text; remotely through a computer network; all users interacting with it remotely through a computer network
agpl; tag; spdx; spdx licen[cs]e identifier agpl [13](?: 0)?(?: only| or later)?
agpl; address; gnu org; gnu org licenses? agpl(?: 3 0)?
agpl; name; affero general public licen; (?:gnu )?affero general public licen[cs]e(?: (?:version )?[13])?
agpl; name; agpl; (?:gnu )?agpl ?v?[13]?
gfdl; text; free documentation license; copy distribute and or modify this document under the terms of the gnu free documentation license
gfdl; tag; spdx; spdx licen[cs]e identifier gfdl 1 [123](?: only| or later)?
gfdl; address; gnu org; gnu org licenses? fdl(?: 1 [123])?
gfdl; name; free documentation licen; (?:gnu )?free documentation licen[cs]e(?: version)?(?: 1 [123])?
bsd; text; redistribution and use in source and binary forms; redistribution and use in source and binary forms with or without modification are permitted
bsd; text; redistributions of source code; redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer
bsd; text; redistributions in binary form; redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer
bsd; address; opensource org; opensource org licenses? bsd license
bsd; name; bsd; bsd (?:style )?licen[cs]e
bsd-2; tag; spdx; spdx licen[cs]e identifier bsd 2 clause
bsd-2; name; bsd; (?:simplified|2 clause|two clause) bsd licen[cs]e
bsd-2; name; bsd; bsd 2 clause(?: licen[cs]e)?
bsd-2; name; freebsd; freebsd licen[cs]e
bsd-3; text; endorse or promote products; names? of (?:its|the|any) .{0,60}contributors (?:may be|to) (?:used to )?endorse or promote products derived from this software without specific prior written permission
bsd-3; tag; spdx; spdx licen[cs]e identifier bsd 3 clause
bsd-3; name; bsd; (?:new|modified|revised|3 clause|three clause) bsd licen[cs]e
bsd-3; name; bsd; bsd 3 clause(?: licen[cs]e)?
bsd-3; address; opensource org; opensource org licenses? bsd 3 clause
bsd-4; text; all advertising materials; all advertising materials mentioning features or use of this software must display the following acknowledgement
bsd-4; tag; spdx; spdx licen[cs]e identifier bsd 4 clause
bsd-4; name; bsd; (?:original|4 clause|four clause) bsd licen[cs]e
bsd-4; name; bsd; bsd 4 clause(?: licen[cs]e)?
0bsd; tag; spdx; spdx licen[cs]e identifier 0bsd
0bsd; name; bsd; (?:zero clause bsd|bsd zero clause)(?: licen[cs]e)?
isc; text; permission to use copy modify and or distribute; permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted
isc; tag; spdx; spdx licen[cs]e identifier isc
isc; address; opensource org; opensource org licenses? isc
isc; name; isc licen; isc licen[cs]e
mpl; text; source code form is subject to; this source code form is subject to the terms of the mozilla public license
mpl; text; mozilla public license; the contents of this file are subject to the mozilla public license
mpl; tag; spdx; spdx licen[cs]e identifier mpl (?:1 [01]|2 0)
mpl; address; mozilla org; mozilla org (?:en us )?mpl(?: 2 0)?
mpl; name; mozilla public licen; mozilla public licen[cs]e(?: version)?(?: (?:1 [01]|2 0))?
mpl; name; mpl; mpl (?:1 [01]|2 0)
epl; text; eclipse public license; program and the accompanying materials are made available under the terms of the eclipse public license
epl; tag; spdx; spdx licen[cs]e identifier epl [12] 0
epl; address; eclipse org; eclipse org legal epl(?: [12] 0| v[12]\d)?
epl; name; eclipse public licen; eclipse public licen[cs]e(?: (?:version )?v? ?[12] 0)?
edl; tag; spdx; spdx licen[cs]e identifier edl 1 0
edl; address; eclipse org; eclipse org org documents edl
edl; name; eclipse distribution licen; eclipse distribution licen[cs]e(?: (?:version )?v? ?1 0)?
cddl; text; common development and distribution license; contents of this file are subject to the terms of the common development and distribution license
cddl; tag; spdx; spdx licen[cs]e identifier cddl 1 [01]
cddl; address; opensource org; opensource org licenses? cddl
cddl; name; common development and distribution licen; common development and distribution licen[cs]e(?: version)?(?: 1 [01])?
cddl; name; cddl; cddl 1 [01]
cpl; tag; spdx; spdx licen[cs]e identifier cpl 1 0
cpl; name; common public licen; common public licen[cs]e(?: version)?(?: 1 0)?
cpal; tag; spdx; spdx licen[cs]e identifier cpal 1 0
cpal; name; common public attribution licen; common public attribution licen[cs]e(?: version)?(?: 1 0)?
eupl; text; european union public licen; licensed under the eupl version 1 [012] .{0,40}european union public licen[cs]e
eupl; tag; spdx; spdx licen[cs]e identifier eupl 1 [012]
eupl; address; joinup ec europa eu; joinup ec europa eu (?:collection|software page) eupl
eupl; name; european union public licen; european union public licen[cs]e(?: version)?(?: 1 [012])?
eupl; name; eupl; eupl (?:v )?1 [012]
cecill; text; cecill; governed by the cecill(?: [bc])? licen[cs]e under french law
cecill; tag; spdx; spdx licen[cs]e identifier cecill [12](?: [01])?
cecill; address; cecill info; cecill info licen[cs]es?
cecill; name; cecill; cecill(?: free software)? licen[cs]e
artistic; text; artistic license; the intent of this document is to state the conditions under which a package may be copied .{0,200}artistic license
artistic; tag; spdx; spdx licen[cs]e identifier artistic [12] 0
artistic; address; perlfoundation org; perlfoundation org artistic
artistic; name; artistic licen; (?:the )?(?:perl )?artistic licen[cs]e(?: version)?(?: [12] 0)?
perl; notice; same terms as perl; (?:modify|redistribute) it under the same terms as perl itself
zlib; text; altered source versions; altered source versions must be plainly marked as such and must not be misrepresented as being the original software
zlib; text; without any express or implied warranty; this software is provided as is without any express or implied warranty in no event will the authors be held liable
zlib; tag; spdx; spdx licen[cs]e identifier zlib
zlib; address; zlib net; zlib net zlib license
zlib; name; zlib; zlib(?: libpng)? licen[cs]e
libpng; tag; spdx; spdx licen[cs]e identifier libpng(?: 2 0)?
libpng; name; png; (?:png reference library|libpng) licen[cs]e
boost; text; boost software license; boost software license version 1 0 august 17th 2003
boost; tag; spdx; spdx licen[cs]e identifier bsl 1 0
boost; address; boost org; boost org license 1 0
boost; name; boost software licen; boost software licen[cs]e(?: version)?(?: 1 0)?
busl; text; change date; change license .{0,60}change date|change date .{0,60}change license
busl; tag; spdx; spdx licen[cs]e identifier busl 1 1
busl; address; mariadb com; mariadb com bsl11
busl; name; business source licen; business source licen[cs]e(?: version)?(?: 1 1)?
sspl; text; server side public license; making the functionality of the program .{0,120}server side public license
sspl; tag; spdx; spdx licen[cs]e identifier sspl 1 0
sspl; address; mongodb com; mongodb com licensing server side public license
sspl; name; server side public licen; server side public licen[cs]e(?: version)?(?: 1)?
elastic; text; hosted or managed service; you may not provide the software to third parties as a hosted or managed service
elastic; tag; spdx; spdx licen[cs]e identifier elastic 2 0
elastic; address; elastic co; elastic co licensing elastic license
elastic; name; elastic licen; elastic licen[cs]e(?: version)?(?: 2 0)?
postgresql; text; permission to use copy modify and distribute; permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement is hereby granted
postgresql; tag; spdx; spdx licen[cs]e identifier postgresql
postgresql; address; postgresql org; postgresql org about licen[cs]e
postgresql; name; postgresql licen; postgresql licen[cs]e
python; text; python software foundation; this license agreement is between the python software foundation psf
python; tag; spdx; spdx licen[cs]e identifier (?:psf|python) 2 0
python; address; python org; python org (?:psf license|3 license html)
python; name; python software foundation licen; python software foundation licen[cs]e(?: version)?(?: 2)?
php; tag; spdx; spdx licen[cs]e identifier php 3 0(?: 1)?
php; address; php net; php net license
php; name; php licen; php licen[cs]e(?: version)?(?: 3 0(?: 1)?)?
ruby; tag; spdx; spdx licen[cs]e identifier ruby
ruby; address; ruby lang org; ruby lang org en about license
ruby; name; ruby; ruby(?: s)? licen[cs]e
openssl; text; openssl toolkit; this product includes software developed by the openssl project for use in the openssl toolkit
openssl; tag; spdx; spdx licen[cs]e identifier openssl
openssl; address; openssl org; openssl org source license
openssl; name; openssl licen; openssl licen[cs]e
w3c; tag; spdx; spdx licen[cs]e identifier w3c(?: 20150513)?
w3c; address; w3 org; w3 org consortium legal
w3c; name; w3c; w3c (?:software (?:notice and )?)?licen[cs]e
unicode; tag; spdx; spdx licen[cs]e identifier unicode dfs 201[56]
unicode; address; unicode org; unicode org (?:copyright|license)
unicode; name; unicode; unicode (?:inc )?licen[cs]e agreement
unlicense; text; unencumbered software; this is free and unencumbered software released into the public domain
unlicense; text; anyone is free to copy modify publish; anyone is free to copy modify publish use compile sell or distribute this software
unlicense; tag; spdx; spdx licen[cs]e identifier unlicense
unlicense; address; unlicense org; unlicense org
unlicense; name; the unlicense; (?:under )?the unlicense
wtfpl; text; do what the; you just do what the f\w+ you want to
wtfpl; tag; spdx; spdx licen[cs]e identifier wtfpl
wtfpl; address; wtfpl net; wtfpl net
wtfpl; name; you want to public licen; do what the f\w+ you want to public licen[cs]e
beerware; text; buy me a beer; if we meet some day and you think this stuff is worth it you can buy me a beer in return
beerware; tag; spdx; spdx licen[cs]e identifier beerware
beerware; name; beer; (?:the )?beer ?ware licen[cs]e
ms-pl; tag; spdx; spdx licen[cs]e identifier ms pl
ms-pl; address; opensource org; opensource org licenses? ms pl
ms-pl; name; microsoft public licen; microsoft public licen[cs]e
ms-rl; tag; spdx; spdx licen[cs]e identifier ms rl
ms-rl; name; microsoft reciprocal licen; microsoft reciprocal licen[cs]e
osl; tag; spdx; spdx licen[cs]e identifier osl [123] [01]
osl; name; open software licen; open software licen[cs]e(?: (?:version )?v? ?[123] [01])?
afl; tag; spdx; spdx licen[cs]e identifier afl [123] [012]
afl; name; academic free licen; academic free licen[cs]e(?: (?:version )?v? ?[123] [012])?
ecl; tag; spdx; spdx licen[cs]e identifier ecl [12] 0
ecl; name; educational community licen; educational community licen[cs]e(?: version)?(?: [12] 0)?
ncsa; tag; spdx; spdx licen[cs]e identifier ncsa
ncsa; name; ncsa; (?:university of illinois )?ncsa(?: open source)? licen[cs]e
vim; tag; spdx; spdx licen[cs]e identifier vim
vim; name; vim licen; vim licen[cs]e
curl; tag; spdx; spdx licen[cs]e identifier curl
json; text; good not evil; the software shall be used for good not evil
json; tag; spdx; spdx licen[cs]e identifier json
qpl; tag; spdx; spdx licen[cs]e identifier qpl 1 0
qpl; name; q public licen; q public licen[cs]e(?: version)?(?: 1 0)?
upl; tag; spdx; spdx licen[cs]e identifier upl 1 0
upl; name; universal permissive licen; universal permissive licen[cs]e(?: (?:version )?v? ?1 0)?
blueoak; tag; spdx; spdx licen[cs]e identifier blueoak 1 0 0
blueoak; name; blue oak model licen; blue oak model licen[cs]e
mulan; tag; spdx; spdx licen[cs]e identifier mulanpsl [12] 0
mulan; name; mulan permissive software licen; mulan permissive software licen[cs]e(?: v(?:ersion)?)?(?: ?[12])?
ofl; text; sil open font license; this font software is licensed under the sil open font license
ofl; tag; spdx; spdx licen[cs]e identifier ofl 1 [01]
ofl; address; scripts sil org; scripts sil org ofl
ofl; name; open font licen; (?:sil )?open font licen[cs]e(?: version)?(?: 1 [01])?
odbl; text; open database license; this .{0,60}database is made available under the open database license
odbl; tag; spdx; spdx licen[cs]e identifier odbl 1 0
odbl; address; opendatacommons org; opendatacommons org licenses? odbl
odbl; name; open database licen; open database licen[cs]e(?: 1 0)?
odc-by; tag; spdx; spdx licen[cs]e identifier odc by 1 0
odc-by; address; opendatacommons org; opendatacommons org licenses? by
odc-by; name; open data commons attribution licen; open data commons attribution licen[cs]e(?: 1 0)?
pddl; tag; spdx; spdx licen[cs]e identifier pddl 1 0
pddl; address; opendatacommons org; opendatacommons org licenses? pddl
pddl; name; public domain dedication and licen; public domain dedication and licen[cs]e(?: 1 0)?
cdla; tag; spdx; spdx licen[cs]e identifier cdla (?:permissive|sharing) [12] 0
cdla; name; community data license agreement; community data license agreement(?: permissive| sharing)?(?: version)?(?: [12] 0)?
ogl; address; nationalarchives gov uk; nationalarchives gov uk doc open government licence
ogl; name; open government licence; open government licence(?: v[123](?: 0)?)?
cc0; text; waived all copyright and related; waived all copyright and related or neighbou?ring rights
cc0; tag; spdx; spdx licen[cs]e identifier cc0 1 0
cc0; address; creativecommons org; creativecommons org publicdomain zero(?: 1 0)?
cc0; name; creative commons zero; creative commons zero(?: licen[cs]e)?(?: 1 0)?(?: universal)?
cc0; name; cc0; (?:creative commons )?cc0(?: licen[cs]e)?(?: 1 0)?(?: universal)?
cc-by; text; copy and redistribute the material; you are free to share copy and redistribute the material in any medium or format
cc-by; tag; spdx; spdx licen[cs]e identifier cc by [1234] [05]
cc-by; notice; cc by; (?:licensed|released|distributed|available|published|provided) under (?:an? |the )?(?:terms of the )?cc by(?: [1234] [05])?(?= (?!sa |nd |nc ))
cc-by; notice; creative commons attribution; (?:licensed|released|distributed|available|published|provided) under (?:an? |the )?(?:terms of the )?creative commons attribution(?: [1234] [05])?(?= (?!share|non|no))
cc-by; address; creativecommons org; creativecommons org licenses? by [1234] [05]
cc-by; name; creative commons attribution; creative commons attribution(?: [1234] [05])?(?: (?:international|unported|generic))?(?: licen[cs]e)?
cc-by; name; cc by; cc by(?: [1234] [05])?(?: (?:international|unported|generic))?(?: licen[cs]e)?
cc-by-sa; tag; spdx; spdx licen[cs]e identifier cc by sa [1234] [05]
cc-by-sa; address; creativecommons org; creativecommons org licenses? by sa(?: [1234] [05])?
cc-by-sa; name; creative commons attribution share; creative commons attribution share ?alike(?: [1234] [05])?
cc-by-sa; name; cc by sa; cc by sa(?: [1234] [05])?
cc-by-nd; tag; spdx; spdx licen[cs]e identifier cc by nd [1234] [05]
cc-by-nd; address; creativecommons org; creativecommons org licenses? by nd(?: [1234] [05])?
cc-by-nd; name; creative commons attribution no; creative commons attribution no ?deriv(?:ative)?s(?: works)?(?: [1234] [05])?
cc-by-nd; name; cc by nd; cc by nd(?: [1234] [05])?
cc-by-nc; tag; spdx; spdx licen[cs]e identifier cc by nc [1234] [05]
cc-by-nc; address; creativecommons org; creativecommons org licenses? by nc(?: [1234] [05])?
cc-by-nc; name; creative commons attribution non; creative commons attribution non ?commercial(?: [1234] [05])?
cc-by-nc; name; cc by nc; cc by nc(?: [1234] [05])?
cc-by-nc-sa; tag; spdx; spdx licen[cs]e identifier cc by nc sa [1234] [05]
cc-by-nc-sa; address; creativecommons org; creativecommons org licenses? by nc sa(?: [1234] [05])?
cc-by-nc-sa; name; creative commons attribution non; creative commons attribution non ?commercial share ?alike(?: [1234] [05])?
cc-by-nc-sa; name; cc by nc sa; cc by nc sa(?: [1234] [05])?
cc-by-nc-nd; tag; spdx; spdx licen[cs]e identifier cc by nc nd [1234] [05]
cc-by-nc-nd; address; creativecommons org; creativecommons org licenses? by nc nd(?: [1234] [05])?
cc-by-nc-nd; name; creative commons attribution non; creative commons attribution non ?commercial no ?deriv(?:ative)?s(?: [1234] [05])?
cc-by-nc-nd; name; cc by nc nd; cc by nc nd(?: [1234] [05])?
public-domain; notice; public domain; (?:released into|dedicated to|placed in(?:to)?|in) the public domain
public-domain; address; creativecommons org; creativecommons org publicdomain mark
public-domain; tag; spdx; spdx licen[cs]e identifier licenseref public domain
proprietary; tag; spdx; spdx licen[cs]e identifier licenseref proprietary
proprietary; notice; all rights reserved; all rights reserved
proprietary; notice; proprietary and confidential; (?:strictly )?proprietary and confidential
proprietary; notice; unauthorized copying; unauthorized copying of this file via any medium is strictly prohibited
proprietary; name; proprietary licen; proprietary licen[cs]e
eula; name; end user licen; end user licen[cs]e agreement(?: eula)?
"""


def signatures() -> list[tuple[str, str, str, str]]:
    """(label, kind, keyword, regex), in order."""
    return [tuple(x.strip() if i else x for i, x in enumerate(line.split("; "))) for line in SIGNATURES.strip().splitlines()]

