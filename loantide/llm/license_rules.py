"""Signature rules of the license scan.

A line is ``priority | label | keyword | pattern``. Patterns run over normalised words joined by single spaces and have to
start and end at word borders; the keyword is a word that every match of the pattern holds. Priority 1: grants and notices;
2: names and identifiers; 3: hints and addresses.
"""

RULES = r"""
1|apache-2.0|apache|licensed under the apache licen[cs]e(?: version)? 2(?: 0)?(?: the licen[cs]e)?
1|apache-2.0|apache|apache licen[cs]e version 2 0 january 2004
1|apache-2.0|apache|(?:released|distributed|available|published) under (?:the )?(?:terms of )?(?:the )?apache(?: software)? licen[cs]e(?: version)?(?: 2(?: 0)?)?
1|apache-1.1|apache|(?:the )?apache software licen[cs]e version 1 1
1|apache-1.0|apache|(?:the )?apache software licen[cs]e version 1 0
1|mit|mit|(?:released|licensed|distributed|available|published|provided) under (?:the )?(?:terms of )?(?:the )?mit licen[cs]e
1|mit|permission|permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files
1|mit|merchantability|the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability
1|mit|substantial|the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software
1|isc|permission|permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted
1|isc|isc|(?:released|licensed|distributed|available) under (?:the )?(?:terms of )?(?:the )?isc licen[cs]e
1|bsd|redistribution|redistribution and use in source and binary forms with or without modification are permitted
1|bsd|bsd|(?:released|licensed|distributed|available) under (?:the )?(?:terms of )?(?:the |a )?(?:[^ ]+ ){0,3}bsd(?: style)? licen[cs]e
1|bsd-3-clause|endorse|neither the name of (?:[^ ]+ ){1,12}may be used to endorse or promote products derived from this software
1|bsd-4-clause|advertising|all advertising materials mentioning features or use of this software must display the following acknowledgement
1|gpl-3.0|gnu|licensed under the gnu general public licen[cs]e(?: v3| version 3)(?: 0)?(?: or (?:any )?later)?
1|gpl-2.0|gnu|licensed under the gnu general public licen[cs]e(?: v2| version 2)(?: 0)?(?: or (?:any )?later)?
1|gpl|redistribute|this program is free software you can redistribute it and or modify it under the terms of the gnu general public licen[cs]e
1|gpl|warranty|this program is distributed in the hope that it will be useful but without any warranty
1|gpl|gnu|you should have received a copy of the gnu general public licen[cs]e
1|gpl|gpl|(?:released|licensed|distributed|available) under (?:the )?(?:terms of )?(?:the )?gpl(?: v[23]| version [23]| [23])?
1|lgpl|lesser|under the terms of the gnu lesser general public licen[cs]e
1|lgpl|library|under the terms of the gnu library general public licen[cs]e
1|lgpl|lgpl|(?:released|licensed|distributed|available) under (?:the )?(?:terms of )?(?:the )?lgpl
1|agpl|affero|under the terms of the gnu affero general public licen[cs]e
1|agpl|agpl|(?:released|licensed|distributed|available) under (?:the )?(?:terms of )?(?:the )?agpl
1|gfdl|documentation|permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation licen[cs]e
1|mpl-2.0|mozilla|this source code form is subject to the terms of the mozilla public licen[cs]e v 2 0
1|mpl-1.1|mozilla|the contents of this file are subject to the mozilla public licen[cs]e version 1 1
1|mpl-1.0|mozilla|the contents of this file are subject to the mozilla public licen[cs]e version 1 0
1|mpl|mozilla|(?:released|licensed|distributed|available) under (?:the )?(?:terms of )?(?:the )?mozilla public licen[cs]e
1|epl-1.0|eclipse|made available under the terms of the eclipse public licen[cs]e v1 0
1|epl-2.0|eclipse|made available under the terms of the eclipse public licen[cs]e(?: v)? 2 0
1|cddl|cddl|subject to the terms of the common development and distribution licen[cs]e(?: [^ ]+){0,4} cddl
1|unlicense|unencumbered|this is free and unencumbered software released into the public domain
1|wtfpl|wtfpl|(?:released|licensed|distributed) under (?:the )?wtfpl
1|zlib|origin|the origin of this software must not be misrepresented you must not claim that you wrote the original software
1|boost|boost|distributed under the boost software licen[cs]e version 1 0
1|artistic|artistic|under the same terms as perl itself or the artistic licen[cs]e
1|public-domain|domain|(?:released|placed|dedicated|put) (?:in|into|to) the public domain
1|public-domain|domain|this work is in the public domain
1|cc0|cc0|(?:released|licensed|dedicated|available) under (?:the )?(?:terms of )?(?:the )?(?:creative commons )?cc0
1|cc0|waived|to the extent possible under law (?:[^ ]+ ){1,12}has waived all copyright and related or neighboring rights
1|cc-by|cc|licensed under (?:a |the )?(?:creative commons )?cc by [1-4](?: [05])?
1|cc-by-sa|cc|licensed under (?:a |the )?(?:creative commons )?cc by sa(?: [1-4](?: [05])?)?
1|cc-by-nc|cc|licensed under (?:a |the )?(?:creative commons )?cc by nc(?: [1-4](?: [05])?)?
1|cc-by-nd|cc|licensed under (?:a |the )?(?:creative commons )?cc by nd(?: [1-4](?: [05])?)?
1|cc-by-nc-sa|cc|licensed under (?:a |the )?(?:creative commons )?cc by nc sa(?: [1-4](?: [05])?)?
1|cc-by-nc-nd|cc|licensed under (?:a |the )?(?:creative commons )?cc by nc nd(?: [1-4](?: [05])?)?
1|cc-by|attribution|licensed under (?:a |the )?creative commons attribution(?: [1-4] [05])?(?: international| unported)? licen[cs]e
1|cc-by-sa|sharealike|licensed under (?:a |the )?creative commons attribution sharealike(?: [1-4] [05])?(?: international| unported)? licen[cs]e
1|cc-by-nc|noncommercial|licensed under (?:a |the )?creative commons attribution noncommercial(?: [1-4] [05])?(?: international| unported)? licen[cs]e
1|cc-by-nd|noderivatives|licensed under (?:a |the )?creative commons attribution noderivatives(?: [1-4] [05])?(?: international| unported)? licen[cs]e
1|cc-by-nc-sa|noncommercial|licensed under (?:a |the )?creative commons attribution noncommercial sharealike(?: [1-4] [05])?(?: international| unported)? licen[cs]e
1|cc-by-nc-nd|noncommercial|licensed under (?:a |the )?creative commons attribution noncommercial noderivatives(?: [1-4] [05])?(?: international| unported)? licen[cs]e
1|ofl-1.1|font|this font software is licensed under the sil open font licen[cs]e version 1 1
1|odbl|database|made available under the open database licen[cs]e
1|odc-by|odc|made available under the open data commons attribution licen[cs]e(?: [^ ]+){0,4} odc
1|pddl|domain|made available under the public domain dedication and licen[cs]e
1|ogl-uk|government|contains public sector information licensed under the open government licen[cs]e(?: v[123](?: 0)?)?
1|proprietary|confidential|this (?:document|software|file|material) is (?:proprietary and confidential|confidential and proprietary)
1|proprietary|prohibited|unauthori[sz]ed (?:copying|use|reproduction|distribution) of this (?:file|document|material|software) (?:[^ ]+ ){0,6}is (?:strictly )?prohibited
1|proprietary|permission|no part of this (?:publication|book|document|work) may be reproduced(?: [^ ]+){1,25} (?:prior )?(?:written )?permission
1|proprietary|redistributed|may not be (?:published broadcast rewritten or )?redistributed
1|proprietary|consent|without (?:the )?(?:prior )?(?:express )?written consent of the (?:copyright )?(?:owner|holder|publisher|author)s?
1|noncommercial|commercial|for (?:personal (?:and|or) )?non commercial use only
1|noncommercial|noncommercial|for (?:personal (?:and|or) )?noncommercial use only
1|research-only|research|for (?:academic )?research (?:purposes|use) only
1|no-ai|training|may not be used (?:for|in) (?:the )?training (?:of )?(?:machine learning|artificial intelligence|ai|language) (?:models|systems)
1|no-ai|mining|text and data mining (?:is|are) (?:not permitted|prohibited|reserved)
1|openrail|rail|licensed under the (?:[^ ]+ ){0,4}open rail(?: [^ ]+)? licen[cs]e
1|llama|llama|licensed under the llama [234](?: [0-9])? community licen[cs]e
2|apache-2.0|apache|(?:the )?apache licen[cs]e(?: version| v)? 2(?: 0)?
2|apache-2.0|apache|apache 2 0(?: licen[cs]e)?
2|apache|apache|(?:the )?apache(?: software)? licen[cs]e
2|apache-2.0|asl|asl 2 0
2|mit|mit|(?:the )?mit licen[cs]e
2|mit|expat|expat licen[cs]e
2|mit-0|mit|mit 0(?: licen[cs]e)?
2|mit-no-attribution|attribution|mit no attribution
2|x11|x11|x11 licen[cs]e
2|isc|isc|isc licen[cs]e
2|bsd-2-clause|bsd|bsd 2 clause(?: licen[cs]e)?
2|bsd-2-clause|simplified|simplified bsd licen[cs]e
2|bsd-2-clause|freebsd|freebsd licen[cs]e
2|bsd-3-clause|bsd|bsd 3 clause(?: licen[cs]e)?
2|bsd-3-clause|bsd|(?:new|revised|modified) bsd licen[cs]e
2|bsd-4-clause|bsd|bsd 4 clause(?: licen[cs]e)?
2|bsd-4-clause|original|original bsd licen[cs]e
2|bsd-0-clause|0bsd|0bsd
2|bsd|bsd|bsd licen[cs]e
2|gpl|general|(?:the )?(?:gnu )?general public licen[cs]e
2|gpl-1.0|gpl|gpl(?: v)? 1(?: 0)?(?: only| or later)?
2|gpl-2.0|gpl|gpl(?: v)? 2(?: 0)?(?: only| or later)?
2|gpl-3.0|gpl|gpl(?: v)? 3(?: 0)?(?: only| or later)?
2|gpl-2.0|gplv2|gplv2(?: or later)?
2|gpl-3.0|gplv3|gplv3(?: or later)?
2|gpl-1.0|general|gnu general public licen[cs]e (?:v1|version 1)(?: or (?:any )?later(?: version)?)?
2|gpl-2.0|general|gnu general public licen[cs]e (?:v2|version 2)(?: or (?:any )?later(?: version)?)?
2|gpl-3.0|general|gnu general public licen[cs]e (?:v3|version 3)(?: or (?:any )?later(?: version)?)?
2|gpl-classpath|classpath|gpl(?: [^ ]+){0,4} classpath exception
2|lgpl|lesser|(?:gnu )?lesser general public licen[cs]e(?: (?:v|version )?[23](?: [01])?)?
2|lgpl-2.0|library|(?:gnu )?library general public licen[cs]e(?: (?:v|version )?2(?: 0)?)?
2|lgpl-2.1|lgpl|lgpl(?: v)? 2 1(?: only| or later)?
2|lgpl-3.0|lgpl|lgpl(?: v)? 3(?: 0)?(?: only| or later)?
2|lgpl-2.1|lgplv2|lgplv2(?: 1)?
2|lgpl-3.0|lgplv3|lgplv3
2|agpl|affero|(?:gnu )?affero general public licen[cs]e(?: (?:v|version )?3(?: 0)?)?
2|agpl-3.0|agpl|agpl(?: v)? 3(?: 0)?(?: only| or later)?
2|agpl-3.0|agplv3|agplv3
2|gfdl|documentation|gnu free documentation licen[cs]e(?: (?:v|version )?1 [123])?
2|gfdl|gfdl|gfdl(?: 1 [123])?
2|mpl-1.0|mpl|mpl 1 0
2|mpl-1.1|mpl|mpl 1 1
2|mpl-2.0|mpl|mpl 2 0
2|mpl-2.0|mozilla|mozilla public licen[cs]e(?: v| version)? 2 0
2|mpl|mozilla|mozilla public licen[cs]e
2|epl-1.0|epl|epl 1 0
2|epl-2.0|epl|epl 2 0
2|epl|eclipse|eclipse public licen[cs]e
2|edl|eclipse|eclipse distribution licen[cs]e(?: v)?(?: 1 0)?
2|cpl-1.0|common|common public licen[cs]e(?: version)?(?: 1 0)?
2|ipl-1.0|ibm|ibm public licen[cs]e(?: version)?(?: 1 0)?
2|cddl|development|common development and distribution licen[cs]e
2|cddl-1.0|cddl|cddl 1 0
2|cddl-1.1|cddl|cddl 1 1
2|eupl|european|european union public licen[cs]e
2|eupl|eupl|eupl(?: v)?(?: 1 [0123])?
2|cecill|cecill|cecill(?: [abc])?(?: [12](?: [01])?)?(?: licen[cs]e)?
2|ms-pl|microsoft|microsoft public licen[cs]e
2|ms-rl|microsoft|microsoft reciprocal licen[cs]e
2|ms-pl|ms|ms pl licen[cs]e
2|artistic-1.0|artistic|artistic licen[cs]e(?: version)? 1 0
2|artistic-2.0|artistic|artistic licen[cs]e(?: version)? 2 0
2|artistic|artistic|artistic licen[cs]e
2|perl|perl|perl licen[cs]e
2|php-3.01|php|php licen[cs]e(?: version)?(?: 3 0[01]?)?
2|psf-2.0|python|python software foundation licen[cs]e(?: version)?(?: 2)?
2|ruby|ruby|ruby licen[cs]e
2|postgresql|postgresql|postgresql licen[cs]e
2|openssl|openssl|openssl licen[cs]e
2|openldap|openldap|openldap public licen[cs]e
2|zlib|zlib|zlib licen[cs]e
2|zlib|libpng|zlib libpng(?: licen[cs]e)?
2|libpng|libpng|libpng licen[cs]e
2|curl|curl|curl licen[cs]e
2|ijg|jpeg|independent jpeg group licen[cs]e
2|icu|icu|icu licen[cs]e
2|unicode|unicode|unicode (?:data files and software )?licen[cs]e
2|w3c|w3c|w3c (?:software (?:notice and )?)?licen[cs]e
2|bsl-1.0|boost|boost software licen[cs]e(?: version)?(?: 1 0)?
2|bsl-1.0|bsl|bsl 1 0
2|busl-1.1|business|business source licen[cs]e(?: version)?(?: 1 1)?
2|busl-1.1|busl|busl 1 1
2|sspl|side|server side public licen[cs]e
2|sspl|sspl|sspl(?: v1| 1 0)?
2|elastic-2.0|elastic|elastic licen[cs]e(?: v)?(?: 2(?: 0)?)?
2|commons-clause|clause|commons clause(?: licen[cs]e)?(?: condition)?
2|polyform|polyform|polyform (?:[^ ]+ )?licen[cs]e
2|confluent|confluent|confluent community licen[cs]e
2|unlicense|unlicense|(?:the )?unlicense
2|wtfpl|fuck|do what the fuck you want to public licen[cs]e
2|wtfpl|wtfpl|wtfpl
2|beerware|beer|beer ware licen[cs]e
2|beerware|beerware|beerware(?: licen[cs]e)?
2|afl-3.0|academic|academic free licen[cs]e(?: v)?(?: [123] [01])?
2|osl-3.0|open|open software licen[cs]e(?: v)?(?: [123] [01])?
2|ecl-2.0|educational|educational community licen[cs]e(?: version)?(?: 2 0)?
2|ncsa|ncsa|(?:university of illinois )?ncsa (?:open source )?licen[cs]e
2|upl-1.0|universal|universal permissive licen[cs]e(?: v)?(?: 1 0)?
2|lppl|latex|latex project public licen[cs]e
2|lppl|lppl|lppl(?: 1 3c?)?
2|sleepycat|sleepycat|sleepycat licen[cs]e
2|qpl|q|q public licen[cs]e
2|vim|vim|vim licen[cs]e
2|zpl|zope|zope public licen[cs]e
2|hpnd|historical|historical permission notice and disclaimer
2|blueoak|oak|blue oak model licen[cs]e(?: 1 0 0)?
2|mulan|mulan|mulan (?:psl|permissive software licen[cs]e)(?: v[12])?
2|ofl-1.1|font|(?:sil )?open font licen[cs]e(?: version)?(?: 1 [01])?
2|ofl-1.1|ofl|ofl 1 1
2|ubuntu-font|ubuntu|ubuntu font licen[cs]e(?: 1 0)?
2|cc|creative|creative commons(?: licen[cs]e)?
2|cc-by|creative|creative commons attribution(?: licen[cs]e)?(?: [1-4] [05])?
2|cc-by-sa|creative|creative commons attribution share(?: )?alike(?: [1-4] [05])?
2|cc-by-nc|creative|creative commons attribution non(?: )?commercial(?: [1-4] [05])?
2|cc-by-nd|creative|creative commons attribution no(?: )?deriv(?:ative)?s(?: [1-4] [05])?
2|cc-by-nc-sa|creative|creative commons attribution non(?: )?commercial share(?: )?alike(?: [1-4] [05])?
2|cc-by-nc-nd|creative|creative commons attribution non(?: )?commercial no(?: )?deriv(?:ative)?s(?: [1-4] [05])?
2|cc0|creative|creative commons zero(?: v1 0)?
2|cc0|cc0|cc0(?: 1 0)?(?: universal)?
2|cc-pdm|mark|public domain mark(?: 1 0)?
2|cc-by-sa|cc|cc by sa(?: [1-4] [05])?
2|cc-by-nc|cc|cc by nc(?: [1-4] [05])?
2|cc-by-nd|cc|cc by nd(?: [1-4] [05])?
2|cc-by-nc-sa|cc|cc by nc sa(?: [1-4] [05])?
2|cc-by-nc-nd|cc|cc by nc nd(?: [1-4] [05])?
2|cc-by|cc|cc by [1-4] [05]
2|cc-sampling|sampling|cc sampling(?: plus)?(?: 1 0)?
2|odbl|odbl|odbl(?: v?1 0)?
2|odbl|database|open database licen[cs]e
2|odc-by|odc|odc by(?: 1 0)?
2|pddl|pddl|pddl(?: 1 0)?
2|cdla|cdla|cdla (?:permissive|sharing)(?: [12] 0)?
2|cdla|community|community data licen[cs]e agreement
2|ogl-uk|government|open government licen[cs]e(?: v[123](?: 0)?)?
2|dl-de|datenlizenz|datenlizenz deutschland(?: namensnennung| zero)?(?: 2 0)?
2|etalab|ouverte|licence ouverte(?: etalab)?(?: [12] 0)?
2|openrail|openrail|(?:[^ ]+ )?openrail(?: m)?(?: licen[cs]e)?
2|rail|responsible|responsible ai licen[cs]e
2|llama|llama|llama [234](?: [0-9])? community licen[cs]e
2|gemma|gemma|gemma terms of use
2|nvidia|nvidia|nvidia (?:open model|source code|software) licen[cs]e
2|json|json|json licen[cs]e
2|copyleft-next|copyleft|copyleft next(?: 0 3 [01])?
2|hippocratic|hippocratic|hippocratic licen[cs]e(?: [123] [0-9])?
2|parity|parity|parity public licen[cs]e
2|spdx|spdx|spdx licen[cs]e identifier(?: [^ ]+){1,4}
3|apache-2.0|apache|apache org licenses(?: licen[cs]e 2 0)?
3|mit|opensource|opensource org licenses mit
3|bsd|opensource|opensource org licenses bsd [^ ]+
3|osi|opensource|opensource org licenses
3|gpl|gnu|gnu org (?:licenses|copyleft)(?: gpl)?
3|mpl-2.0|mozilla|mozilla org mpl(?: 2 0)?
3|cc|creativecommons|creativecommons org
3|cc-by|creativecommons|creativecommons org licenses by [1-4] [05]
3|cc-by-sa|creativecommons|creativecommons org licenses by sa [1-4] [05]
3|cc-by-nc|creativecommons|creativecommons org licenses by nc [1-4] [05]
3|cc-by-nd|creativecommons|creativecommons org licenses by nd [1-4] [05]
3|cc-by-nc-sa|creativecommons|creativecommons org licenses by nc sa [1-4] [05]
3|cc-by-nc-nd|creativecommons|creativecommons org licenses by nc nd [1-4] [05]
3|cc0|creativecommons|creativecommons org publicdomain zero 1 0
3|cc-pdm|creativecommons|creativecommons org publicdomain mark 1 0
3|unlicense|unlicense|unlicense org
3|odc|opendatacommons|opendatacommons org licenses [^ ]+
3|public-domain|domain|public domain
3|copyright|copyright|copyright (?:c )?(?:19|20)[0-9][0-9](?: (?:19|20)?[0-9][0-9])?
3|copyright|copyright|(?:all )?copyright (?:is |are )?(?:owned|held) by
3|copyright|copyrighted|copyrighted (?:material|work|content)
3|reserved|rights|some rights reserved
3|reserved|rights|no rights reserved
3|license-file|license|see (?:the )?license (?:file )?(?:for|in)
3|license-file|license|license (?:txt|md|file)
3|licensed|licensed|(?:dual |multi )?licensed under(?: the| a)?(?: terms of)?
3|open-source|source|open source licen[cs]e
3|permissive|permissive|permissive licen[cs]e
3|copyleft|copyleft|copyleft(?: licen[cs]e)?
3|royalty-free|royalty|royalty free licen[cs]e
3|trademark|trademark|(?:is )?(?:a )?(?:registered )?trademark of
3|eula|agreement|end user licen[cs]e agreement(?: eula)?
3|eula|eula|eula
3|terms|terms|terms (?:of (?:use|service)|and conditions) apply
"""


def rules() -> list[tuple[int, int, str, str, str]]:
    """(order, priority, label, keyword, pattern) of each rule, in the order above."""
    out = []
    for line in RULES.strip().splitlines():
        priority, label, keyword, pattern = line.split("|", 3)
        out.append((len(out), int(priority), label, keyword, pattern))
    return out


#: Phrases whose places are all counted, with their labels.
BASE_PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
