"""The ordered signature rules of ``license_scan``, written by hand.

One rule a line: class, label, keyword, regex.  A regex stands for whole words
of a normalised text (lower-cased words joined by single blanks, so ``2.0`` is
``2 0`` and ``or-later`` is ``or later``); the keyword is a string that every
match holds, and a text without it is never searched with the regex.  Classes,
from the strongest evidence to the weakest:

``tag`` machine-readable identifiers, ``text`` sentences of the licence text or
of its standard notice, ``link`` addresses of the licence, ``name`` the licence
named with version, ``family`` named without, ``hint`` wording that only tells
of some licence.  Order within a class breaks ties: the earlier rule wins.
"""

from __future__ import annotations

CLASSES = {"tag": 0.98, "text": 0.95, "link": 0.9, "name": 0.85, "family": 0.6, "hint": 0.3}     # weight of a detection

SIGNATURES = r"""
tag    gpl-2.0-only        identifier  spdx license identifier gpl 2 0(?: only)?
tag    gpl-2.0-or-later    identifier  spdx license identifier gpl 2 0 or later
tag    gpl-3.0-only        identifier  spdx license identifier gpl 3 0(?: only)?
tag    gpl-3.0-or-later    identifier  spdx license identifier gpl 3 0 or later
tag    gpl-1.0-or-later    identifier  spdx license identifier gpl 1 0 or later
tag    lgpl-2.0            identifier  spdx license identifier lgpl 2 0(?: only| or later)?
tag    lgpl-2.1-only       identifier  spdx license identifier lgpl 2 1(?: only)?
tag    lgpl-2.1-or-later   identifier  spdx license identifier lgpl 2 1 or later
tag    lgpl-3.0-only       identifier  spdx license identifier lgpl 3 0(?: only)?
tag    lgpl-3.0-or-later   identifier  spdx license identifier lgpl 3 0 or later
tag    agpl-3.0-only       identifier  spdx license identifier agpl 3 0(?: only)?
tag    agpl-3.0-or-later   identifier  spdx license identifier agpl 3 0 or later
tag    gfdl                identifier  spdx license identifier gfdl 1 [123](?: only| or later)?
tag    apache-2.0          identifier  spdx license identifier apache 2 0
tag    apache-1.1          identifier  spdx license identifier apache 1 1
tag    mit                 identifier  spdx license identifier mit
tag    mit-0               identifier  spdx license identifier mit 0
tag    x11                 identifier  spdx license identifier x11
tag    isc                 identifier  spdx license identifier isc
tag    0bsd                identifier  spdx license identifier 0bsd
tag    bsd-2-clause        identifier  spdx license identifier bsd 2 clause
tag    bsd-3-clause        identifier  spdx license identifier bsd 3 clause
tag    bsd-4-clause        identifier  spdx license identifier bsd 4 clause
tag    mpl-1.1             identifier  spdx license identifier mpl 1 1
tag    mpl-2.0             identifier  spdx license identifier mpl 2 0
tag    epl-1.0             identifier  spdx license identifier epl 1 0
tag    epl-2.0             identifier  spdx license identifier epl 2 0
tag    eupl                identifier  spdx license identifier eupl 1 [012]
tag    cddl                identifier  spdx license identifier cddl 1 [01]
tag    bsl-1.0             identifier  spdx license identifier bsl 1 0
tag    zlib                identifier  spdx license identifier zlib
tag    unlicense           identifier  spdx license identifier unlicense
tag    wtfpl               identifier  spdx license identifier wtfpl
tag    artistic-2.0        identifier  spdx license identifier artistic 2 0
tag    psf-2.0             identifier  spdx license identifier (?:psf|python) 2 0(?: 1)?
tag    ofl-1.1             identifier  spdx license identifier ofl 1 1
tag    postgresql          identifier  spdx license identifier postgresql
tag    cc0-1.0             identifier  spdx license identifier cc0 1 0
tag    cc-by-sa            identifier  spdx license identifier cc by sa [1-4] [05]
tag    cc-by-nc-sa         identifier  spdx license identifier cc by nc sa [1-4] [05]
tag    cc-by-nc-nd         identifier  spdx license identifier cc by nc nd [1-4] [05]
tag    cc-by-nc            identifier  spdx license identifier cc by nc [1-4] [05]
tag    cc-by-nd            identifier  spdx license identifier cc by nd [1-4] [05]
tag    cc-by               identifier  spdx license identifier cc by [1-4] [05]
tag    odbl-1.0            identifier  spdx license identifier odbl 1 0
tag    sspl-1.0            identifier  spdx license identifier sspl 1 0
tag    busl-1.1            identifier  spdx license identifier busl 1 1
tag    elastic-2.0         identifier  spdx license identifier elastic 2 0
tag    spdx-other          identifier  spdx license identifier (?:licenseref [^ ]+|none|noassertion)

text   mit                 hereby      permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files
text   mit                 portions    the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software
text   bsl-1.0             hereby      permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation
text   isc                 purpose     permission to use copy modify and(?: or)? distribute this software for any purpose with or without fee is hereby granted provided that
text   0bsd                purpose     permission to use copy modify and(?: or)? distribute this software for any purpose with or without fee is hereby granted the software is provided as is
text   ntp                 purpose     permission to use copy modify and distribute this software and its documentation for any purpose with or without fee is hereby granted
text   historical          purpose     permission to use copy modify and distribute this software and its documentation for any purpose is hereby granted without fee
text   bsd-3-clause        endorse     neither the names? of(?: [^ ]+){1,12} nor the names of(?: [^ ]+){0,3} contributors may be used to endorse or promote products
text   bsd-2-clause        redistribu  redistribution and use in source and binary forms with or without modification are permitted
text   bsd-4-clause        advertising all advertising materials mentioning features or use of this software must display the following acknowledge?ment
text   bsd                 binary      redistributions in binary form must reproduce the above copyright notice this list of conditions
text   bsd                 retain      redistributions of source code must retain the above copyright notice
text   apache-2.0          compliance  licensed under the apache license version 2 0(?: the license)? you may not use this (?:file|work|software) except in compliance with the license
text   apache-2.0          apache      terms and conditions of the apache license version 2 0
text   apache-1.1          apache      the apache software license version 1 1
text   gpl-2.0-or-later    redistribu  you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or(?: at your option)? any later version
text   gpl-3.0-or-later    redistribu  you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or(?: at your option)? any later version
text   lgpl-2.1-or-later   lesser      under the terms of the gnu lesser general public license as published by the free software foundation either version 2 1 of the license or(?: at your option)? any later version
text   lgpl-3.0-or-later   lesser      under the terms of the gnu lesser general public license as published by the free software foundation either version 3 of the license or(?: at your option)? any later version
text   lgpl-2.0-or-later   library     under the terms of the gnu library general public license as published by the free software foundation either version 2 of the license or(?: at your option)? any later version
text   agpl-3.0-or-later   affero      under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license or(?: at your option)? any later version
text   gpl                 warranty    without even the implied warranty of merchantability or fitness for a particular purpose see the gnu general public license for more details
text   lgpl                warranty    without even the implied warranty of merchantability or fitness for a particular purpose see the gnu (?:lesser|library) general public license for more details
text   agpl                warranty    without even the implied warranty of merchantability or fitness for a particular purpose see the gnu affero general public license for more details
text   gfdl                copy        permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license
text   mpl-2.0             mozilla     this source code form is subject to the terms of the mozilla public license v 2 0
text   mpl-1.1             mozilla     the contents of this file are subject to the mozilla public license version 1 1
text   epl-1.0             eclipse     made available under the terms of the eclipse public license v1 0
text   epl-2.0             eclipse     made available under the terms of the eclipse public license (?:v ?)?2 0
text   cddl                development the contents of this file are subject to the terms of the common development and distribution license
text   zlib                misrepres   the origin of this software must not be misrepresented
text   zlib                altered     altered source versions must be plainly marked as such
text   unlicense           unencumber  this is free and unencumbered software released into the public domain
text   wtfpl               fuck        do what the fuck you want to(?: public license)?
text   beerware            beer        if we meet some day and you think this stuff is worth it you can buy me a beer
text   json                evil        the software shall be used for good not evil
text   cc0-1.0             waived      has waived all copyright and related or neighboring rights
text   cc0-1.0             dedicated   dedicated(?: [^ ]+){0,6} to the public domain by waiving all of (?:his|her|their|his or her) rights
text   ofl-1.1             font        this font software is licensed under the sil open font license version 1 1
text   artistic-1.0        artistic    under the same terms as perl(?: [0-9] [0-9]+)? itself(?: [^ ]+){0,12} artistic license
text   perl                perl        (?:under|on) the same terms as perl(?: [0-9]+)? itself
text   ruby                ruby        (?:under|on) the same terms as ruby(?: itself)?
text   postgresql          postgresql  postgresql is released under the postgresql license
text   ncsa                restriction permission is hereby granted(?: [^ ]+){1,20} to deal with the software without restriction
text   x11                 consortium  except as contained in this notice the name of the x consortium shall not be used
text   ms-pl               microsoft   this license governs use of the accompanying software(?: [^ ]+){0,40} microsoft public license
text   commons-clause      sell        the license does not grant to you the right to sell the software
text   busl-1.1            change      (?:the )?change date(?: [^ ]+){0,30} change license
text   elastic-2.0         elastic     you may not provide the software to third parties as a hosted or managed service(?: [^ ]+){0,30} elastic
text   openssl             openssl     this product includes software developed by the openssl project

link   mit                 licenses    opensource org licenses mit(?: license)?(?: php| html)?
link   bsd-2-clause        licenses    opensource org licenses bsd (?:2 clause|license)(?: php)?
link   bsd-3-clause        licenses    opensource org licenses bsd 3 clause
link   isc                 licenses    opensource org licenses isc(?: license)?
link   artistic-2.0        licenses    opensource org licenses artistic (?:license )?2 0
link   osl-3.0             licenses    opensource org licenses osl 3 0
link   afl-3.0             licenses    opensource org licenses afl 3 0
link   apache-2.0          apache      (?:www )?apache org licenses license 2 0(?: txt| html)?
link   apache-1.1          apache      (?:www )?apache org licenses license 1 1
link   gpl-2.0             licenses    (?:www )?gnu org licenses (?:old licenses )?gpl 2 0(?: [a-z]+)?
link   gpl-3.0             licenses    (?:www )?gnu org licenses gpl 3 0(?: [a-z]+)?
link   lgpl-2.1            licenses    (?:www )?gnu org licenses (?:old licenses )?lgpl 2 1(?: [a-z]+)?
link   lgpl-3.0            licenses    (?:www )?gnu org licenses lgpl 3 0(?: [a-z]+)?
link   agpl-3.0            licenses    (?:www )?gnu org licenses agpl(?: 3 0)?(?: [a-z]+)?
link   gfdl                gnu         (?:www )?gnu org (?:licenses|copyleft) fdl(?: [a-z]+)?
link   gpl                 gnu         (?:www )?gnu org (?:licenses|copyleft) (?:gpl|licenses)(?: [a-z]+)?
link   cc0-1.0             publicdomain creativecommons org publicdomain zero 1 0
link   cc-pdm-1.0          publicdomain creativecommons org publicdomain mark 1 0
link   cc-by-nc-sa         creativecommons  creativecommons org licenses by nc sa [1-4] [05]
link   cc-by-nc-nd         creativecommons  creativecommons org licenses by (?:nc nd|nd nc) [1-4] [05]
link   cc-by-nc            creativecommons  creativecommons org licenses by nc [1-4] [05]
link   cc-by-nd            creativecommons  creativecommons org licenses by nd [1-4] [05]
link   cc-by-sa            creativecommons  creativecommons org licenses by sa [1-4] [05]
link   cc-by               creativecommons  creativecommons org licenses by [1-4] [05]
link   mpl-2.0             mozilla     mozilla org (?:[a-z]+ )?mpl 2 0
link   mpl                 mozilla     mozilla org (?:[a-z]+ )?mpl
link   epl-1.0             eclipse     eclipse org (?:legal|org documents) epl v10(?: html)?
link   epl-2.0             eclipse     eclipse org legal epl (?:v20|2 0)(?: html)?
link   bsl-1.0             boost       boost org license 1 0(?: txt)?
link   unlicense           unlicense   unlicense org
link   wtfpl               wtfpl       (?:www )?wtfpl net
link   ofl-1.1             ofl         scripts sil org ofl
link   odbl-1.0            opendatacommons opendatacommons org licenses odbl(?: 1 0)?
link   odc-by              opendatacommons opendatacommons org licenses by(?: 1 0)?
link   pddl                opendatacommons opendatacommons org licenses pddl(?: 1 0)?
link   ogl-uk              nationalarchives nationalarchives gov uk doc open government licen[cs]e(?: version [1-3])?
link   eupl                eupl        joinup ec europa eu(?: [^ ]+){0,6} eupl
link   cecill              cecill      (?:www )?cecill info(?: [^ ]+){0,3}
link   psf-2.0             python      docs python org (?:[23] )?license(?: html)?
link   php-3.01            php         (?:www )?php net license 3 0 ?1?

name   gpl-3.0-or-later    gpl         (?:gnu )?gpl ?(?:v ?|version )?3(?: 0)? (?:or later|or any later version|or newer)
name   gpl-2.0-or-later    gpl         (?:gnu )?gpl ?(?:v ?|version )?2(?: 0)? (?:or later|or any later version|or newer)
name   gpl-3.0             gpl         (?:gnu )?gpl ?(?:v ?|version )?3(?: 0)?(?: only)?
name   gpl-2.0             gpl         (?:gnu )?gpl ?(?:v ?|version )?2(?: 0)?(?: only)?
name   gpl-3.0-or-later    general     gnu general public licen[cs]e (?:v ?|version )?3(?: 0)? or (?:any )?later(?: version)?
name   gpl-2.0-or-later    general     gnu general public licen[cs]e (?:v ?|version )?2(?: 0)? or (?:any )?later(?: version)?
name   gpl-3.0             general     gnu general public licen[cs]e (?:v ?|version )?3(?: 0)?
name   gpl-2.0             general     gnu general public licen[cs]e (?:v ?|version )?2(?: 0)?
name   gpl-1.0             general     gnu general public licen[cs]e (?:v ?|version )?1(?: 0)?
name   gpl-3.0             general     version 3(?: 0)? of the gnu general public licen[cs]e
name   gpl-2.0             general     version 2(?: 0)? of the gnu general public licen[cs]e
name   lgpl-3.0            lgpl        (?:gnu )?lgpl ?(?:v ?|version )?3(?: 0)?(?: only| or later)?
name   lgpl-2.1            lgpl        (?:gnu )?lgpl ?(?:v ?|version )?2 1(?: only| or later)?
name   lgpl-3.0            lesser      gnu lesser general public licen[cs]e (?:v ?|version )?3(?: 0)?
name   lgpl-2.1            lesser      gnu lesser general public licen[cs]e (?:v ?|version )?2 1
name   lgpl-2.0            library     gnu library general public licen[cs]e (?:v ?|version )?2(?: 0)?
name   agpl-3.0            agpl        (?:gnu )?agpl ?(?:v ?|version )?3(?: 0)?(?: only| or later)?
name   agpl-3.0            affero      gnu affero general public licen[cs]e (?:v ?|version )?3(?: 0)?
name   gfdl                documentation gnu free documentation licen[cs]e(?: (?:v ?|version )?1 [123])?
name   apache-2.0          apache      apache (?:software )?licen[cs]e (?:v ?|version )?2(?: 0)?
name   apache-2.0          apache      apache (?:v ?|version )?2(?: 0)?(?: licen[cs]e)?
name   apache-2.0          asl         asl 2 0
name   apache-1.1          apache      apache (?:software )?licen[cs]e (?:v ?|version )?1 1
name   apache-1.0          apache      apache (?:software )?licen[cs]e (?:v ?|version )?1 0
name   mit-0               attribution mit no attribution(?: licen[cs]e)?
name   mit                 expat       (?:mit )?expat licen[cs]e
name   x11                 x11         (?:mit )?x11 licen[cs]e
name   bsd-2-clause        bsd         (?:simplified|freebsd|(?:2|two) clause) bsd(?: licen[cs]e)?
name   bsd-2-clause        bsd         bsd (?:2|two) clause(?: licen[cs]e)?
name   bsd-3-clause        bsd         (?:new|revised|modified|(?:3|three) clause) bsd(?: licen[cs]e)?
name   bsd-3-clause        bsd         bsd (?:3|three) clause(?: licen[cs]e)?
name   bsd-4-clause        bsd         (?:original|(?:4|four) clause) bsd(?: licen[cs]e)?
name   bsd-4-clause        bsd         bsd (?:4|four) clause(?: licen[cs]e)?
name   0bsd                bsd         (?:0bsd|(?:0|zero) clause bsd)(?: licen[cs]e)?
name   mpl-2.0             mozilla     mozilla public licen[cs]e (?:v ?|version )?2(?: 0)?
name   mpl-1.1             mozilla     mozilla public licen[cs]e (?:v ?|version )?1 1
name   mpl-2.0             mpl         mpl ?(?:v ?|version )?2 0
name   epl-2.0             eclipse     eclipse public licen[cs]e (?:v ?|version )?2(?: 0)?
name   epl-1.0             eclipse     eclipse public licen[cs]e (?:v ?|version )?1(?: 0)?
name   edl-1.0             eclipse     eclipse distribution licen[cs]e(?: (?:v ?|version )?1 0)?
name   bsl-1.0             boost       boost software licen[cs]e(?: (?:v ?|version )?1 0)?
name   cc0-1.0             cc0         cc0(?: 1 0)?(?: universal)?
name   cc-by-nc-sa         by nc sa    (?:cc )?by nc sa(?: [1-4] [05])?
name   cc-by-nc-nd         cc by       cc by nc nd(?: [1-4] [05])?
name   cc-by-nc            cc by       cc by nc(?: [1-4] [05])?
name   cc-by-nd            cc by       cc by nd(?: [1-4] [05])?
name   cc-by-sa            cc by       cc by sa(?: [1-4] [05])?
name   cc-by               cc by       cc by [1-4] [05]
name   cc-by-nc-sa         creative    creative commons attribution non ?commercial share ?alike(?: [1-4] [05])?
name   cc-by-nc-nd         creative    creative commons attribution non ?commercial no ?deriv[a-z]*(?: [1-4] [05])?
name   cc-by-nc            creative    creative commons attribution non ?commercial(?: [1-4] [05])?
name   cc-by-nd            creative    creative commons attribution no ?deriv[a-z]*(?: [1-4] [05])?
name   cc-by-sa            creative    creative commons attribution share ?alike(?: [1-4] [05])?
name   cc-by               creative    creative commons attribution(?: [1-4] [05]| licen[cs]e)
name   cc0-1.0             creative    creative commons zero(?: (?:v ?)?1 0)?
name   odbl-1.0            database    open (?:data commons )?(?:open )?database licen[cs]e
name   ogl-uk              government  open government licen[cs]e(?: (?:v ?|version )?[1-3](?: 0)?)?
name   artistic-2.0        artistic    artistic licen[cs]e (?:v ?|version )?2(?: 0)?
name   artistic-1.0        artistic    artistic licen[cs]e (?:v ?|version )?1(?: 0)?
name   psf-2.0             python      python software foundation licen[cs]e(?: (?:v ?|version )?2)?
name   ofl-1.1             font        (?:sil )?open font licen[cs]e(?: (?:v ?|version )?1 1)?
name   cddl                cddl        cddl ?(?:v ?|version )?1 [01]
name   cpl-1.0             common      common public licen[cs]e(?: (?:v ?|version )?1 0)?
name   cpal-1.0            attribution common public attribution licen[cs]e(?: (?:v ?|version )?1 0)?
name   eupl                eupl        eupl ?(?:v ?|version )?1 [012]
name   osl-3.0             open        open software licen[cs]e(?: (?:v ?|version )?[123] [01])?
name   afl-3.0             academic    academic free licen[cs]e(?: (?:v ?|version )?[123] [01])?
name   ecl-2.0             educational educational community licen[cs]e(?: (?:v ?|version )?2 0)?
name   lppl                latex       latex project public licen[cs]e(?: (?:v ?|version )?1 [0-3][ac]?)?
name   ms-pl               microsoft   microsoft public licen[cs]e
name   ms-rl               microsoft   microsoft reciprocal licen[cs]e
name   sspl-1.0            server      server side public licen[cs]e(?: (?:v ?|version )?1)?
name   busl-1.1            business    business source licen[cs]e(?: (?:v ?|version )?1 1)?
name   elastic-2.0         elastic     elastic licen[cs]e(?: (?:v ?|version )?2(?: 0)?)?
name   polyform            polyform    polyform (?:noncommercial|small business|strict|shield|perimeter|free trial|internal use)(?: licen[cs]e)?(?: 1 0 0)?
name   hippocratic         hippocratic hippocratic licen[cs]e(?: [123] [01])?
name   upl-1.0             universal   universal permissive licen[cs]e(?: (?:v ?|version )?1 0)?
name   openrail            rail        (?:creativeml |bigscience |bigcode )?open ?rail ?[ms]?(?: licen[cs]e)?

family lgpl                lesser      (?:gnu )?lesser general public licen[cs]e
family lgpl                library     (?:gnu )?library general public licen[cs]e
family agpl                affero      (?:gnu )?affero general public licen[cs]e
family lgpl                lgpl        (?:gnu )?lgpl
family agpl                agpl        (?:gnu )?agpl
family gpl                 gpl         (?:gnu )?gpl
family gpl                 general     (?:gnu )?general public licen[cs]e
family apache              apache      apache (?:software )?licen[cs]e[ds]?
family mit                 mit li      mit licen[cs]ed?
family bsd                 bsd         bsd (?:style )?licen[cs]ed?
family isc                 isc li      isc licen[cs]ed?
family mpl                 mozilla     mozilla public licen[cs]e
family epl                 eclipse     eclipse public licen[cs]e
family cddl                development common development and distribution licen[cs]e
family eupl                european    european union public licen[cs]e
family cecill              cecill      cecill(?: [bc])?(?: licen[cs]e)?
family zlib                zlib        zlib(?: libpng)? licen[cs]e
family libpng              libpng      libpng licen[cs]e
family artistic            artistic    artistic licen[cs]e
family postgresql          postgresql  postgresql licen[cs]e
family php                 php         php licen[cs]e(?: 3 01?)?
family ruby                ruby        ruby licen[cs]e
family vim                 vim         vim licen[cs]e
family openssl             openssl     openssl licen[cs]e
family unlicense           unlicense   (?:the )?unlicense
family wtfpl               wtfpl       wtfpl
family beerware            beer        beer ?ware(?: licen[cs]e)?
family ncsa                ncsa        (?:university of illinois )?ncsa(?: open source)? licen[cs]e
family w3c                 w3c         w3c (?:software )?(?:notice and )?licen[cs]e
family zpl                 zope        zope public licen[cs]e
family qpl                 public      q public licen[cs]e
family creative-commons    creative    creative commons(?: licen[cs]e)?
family openrail            responsible responsible ai licen[cs]e

hint   copyright           reserved    all rights reserved
hint   copyright           copyright   copyright (?:c )?(?:19|20)[0-9][0-9](?: (?:19|20)[0-9][0-9])*
hint   public-domain       domain      (?:in|into|to) the public domain
hint   proprietary         proprietary proprietary and confidential
hint   proprietary         prohibited  (?:unauthori[sz]ed )?(?:copying|reproduction|redistribution)(?: [^ ]+){0,8} (?:is )?(?:strictly )?prohibited
hint   proprietary         permission  may not be (?:reproduced|copied|redistributed)(?: [^ ]+){0,10} without(?: [^ ]+){0,4} permission
hint   dual                dual        dual licen[cs]ed
hint   open-source         open        open source licen[cs]e
hint   permissive          free        free for (?:any|personal|non ?commercial|academic) use
hint   non-commercial      commercial  (?:for )?non ?commercial (?:use|purposes) only
hint   notice              licen       (?:see|refer to)(?: the)?(?: [^ ]+){0,2} licen[cs]e(?: file| txt| md)? for (?:more )?(?:details|terms|information)
hint   notice              licen       (?:licen[cs]ed|released|distributed|available) under(?: the terms of)?(?: [^ ]+){1,5} licen[cs]e
"""


def rules() -> list[tuple[str, str, str, str]]:
    """``(class, label, keyword, regex)`` in order."""
    kinds = tuple(CLASSES)
    out = []
    for line in SIGNATURES.strip().splitlines():
        if not line.strip():
            continue
        kind, label, rest = line.split(None, 2)
        for two in ("by nc sa    ", "cc by       ", "mit li      ", "isc li      "):      # keywords of several words
            if rest.startswith(two):
                keyword, pattern = two.strip(), rest[len(two):]
                break
        else:
            keyword, pattern = rest.split(None, 1)
        assert kind in kinds
        out.append((kind, label, keyword, pattern.strip()))
    return out
