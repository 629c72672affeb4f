"""Hand-written signature rules for license texts, notices, names, tags and addresses.

One rule a line: priority, label, keyword, pattern. Patterns are regular expressions over a
text's lower-case words joined by one space; a keyword is a word that stands in every
match of its rule, and is looked for first. Priorities: 1 sentences of a license itself, 2 a
name with its version, a tag or an address, 3 a bare name, 9 a mention of licensing that names no
license. No pattern matches more than 40 words. Earlier rules go before later ones.
"""

from __future__ import annotations

from typing import NamedTuple

GENERIC = 9


class Rule(NamedTuple):
    priority: int
    label: str
    keyword: str
    pattern: str
    base: bool = False


# Fixed phrases and labels of the contract; their places all count, whatever overlaps them.
BASE = [
    Rule(3, "gpl", "gnu", "gnu general public license", True),
    Rule(3, "apache", "apache", "apache license", True),
    Rule(3, "cc-by", "cc", "cc by", True),
    Rule(3, "mit", "mit", "mit license", True),
]

_WRITTEN = r"""
1 agpl-3.0 affero this program is free software you can redistribute it and or modify it under the terms of the gnu affero general public license as published
1 lgpl-2.1 lesser this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published
1 gpl-2.0-or-later gnu gnu general public license as published by the free software foundation either version 2 of the license or( at your option)? any later version
1 gpl-3.0-or-later gnu gnu general public license as published by the free software foundation either version 3 of the license or( at your option)? any later version
1 gpl-2.0-only gnu gnu general public license version 2 only as published by the free software foundation
1 gpl-2.0-only gnu gnu general public license version 2 as published by the free software foundation
1 gpl-3.0-only gnu gnu general public license version 3 only as published by the free software foundation
1 gpl-3.0-only gnu gnu general public license version 3 as published by the free software foundation
1 lgpl-2.1-or-later lesser gnu lesser general public license as published by the free software foundation either version 2 1 of the license or( at your option)? any later version
1 lgpl-3.0-or-later lesser gnu lesser general public license as published by the free software foundation either version 3 of the license or( at your option)? any later version
1 lgpl-2.0-or-later library gnu library general public license as published by the free software foundation either version 2 of the license or( at your option)? any later version
1 agpl-3.0-or-later affero gnu affero general public license as published by the free software foundation either version 3 of the license or( at your option)? any later version
1 gfdl-1.3 gnu permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license version 1 3
1 gfdl-1.2 gnu permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license version 1 2
1 mit hereby permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files
1 mit sublicense to use copy modify merge publish distribute sublicense and or sell copies of the software
1 isc hereby permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that
1 0bsd hereby permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted
1 hpnd hereby permission to use copy modify and distribute this software and its documentation for any purpose and without fee is hereby granted
1 postgresql hereby permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement is hereby granted
1 bsd-2-clause redistribution redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met
1 bsd-3-clause endorse neither the name of [^ ]+( [^ ]+){0,8} nor the names of (its|their) contributors may be used to endorse or promote products derived from this software
1 bsd-3-clause endorse may not be used to endorse or promote products derived from this software without specific prior written permission
1 bsd-4-clause advertising all advertising materials mentioning features or use of this software must display the following acknowledge?ment
1 bsd-3-clause-clear patent no express or implied licenses to any party s patent rights are granted by this license
1 apache-2.0 apache licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license
1 apache-2.0 unless unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis
1 apache-1.1 apache this product includes software developed by the apache software foundation
1 mpl-2.0 mozilla this source code form is subject to the terms of the mozilla public license v( )?2 0
1 mpl-1.1 mozilla the contents of this file are subject to the mozilla public license version 1 1
1 mpl-1.0 mozilla the contents of this file are subject to the mozilla public license version 1 0
1 epl-2.0 eclipse this program and the accompanying materials are made available under the terms of the eclipse public license( v)? 2 0
1 epl-1.0 eclipse this program and the accompanying materials are made available under the terms of the eclipse public license v1 0
1 cddl-1.0 cddl the contents of this file are subject to the terms of the common development and distribution license( the license or)? cddl
1 cddl-1.0 cddl this file and its contents are supplied under the terms of the common development and distribution license( cddl)? version 1 0( [^ ]+){0,3} cddl
1 zlib warranty this software is provided as is without any express or implied warranty in no event will the authors be held liable
1 zlib altered altered source versions must be plainly marked as such and must not be misrepresented as being the original software
1 bsl-1.0 boost distributed under the boost software license version 1 0
1 bsl-1.0 boost boost software license version 1 0 august 17th 2003
1 unlicense unencumbered this is free and unencumbered software released into the public domain
1 unlicense anyone anyone is free to copy modify publish use compile sell or distribute this software either in source code form or as a compiled binary
1 cc0-1.0 cc0 to the extent possible under law( [^ ]+){1,8} has waived all copyright and related or neighboring rights to( [^ ]+){0,6} cc0
1 cc0-1.0 waived has waived all copyright and related or neighboring rights to this work
1 wtfpl fuck do what the fuck you want to public license
1 wtfpl fuck you just do what the fuck you want to
1 artistic-2.0 artistic this is free software licensed under the artistic license( version)? 2 0
1 artistic-1.0-perl perl this( [^ ]+){1,4} is free software you can redistribute it and or modify it under the same terms as perl( 5)? itself
1 perl perl redistribute it and or modify it under the same terms as perl itself
1 ofl-1.1 sil this font software is licensed under the sil open font license version 1 1
1 ofl-1.1 font permission is hereby granted free of charge to any person obtaining a copy of the font software to use study copy
1 ms-pl microsoft this license governs use of the accompanying software( [^ ]+){0,20} microsoft public license
1 eupl-1.2 eupl licensed under the eupl( version)? 1 2
1 eupl-1.1 eupl licensed under the eupl( version)? 1 1
1 python-2.0 psf psf is making python available to licensee on an as is basis
1 openssl openssl this product includes software developed by the openssl project for use in the openssl toolkit
1 ssleay eric this product includes cryptographic software written by eric young
1 curl hereby permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies
1 ncsa university permission is hereby granted free of charge( [^ ]+){1,12} university of illinois ncsa
1 afl-3.0 academic licensed under the academic free license version 3 0
1 afl-2.1 academic licensed under the academic free license version 2 1
1 osl-3.0 open licensed under the open software license version 3 0
1 json evil the software shall be used for good not evil
1 beerware beer you can buy me a beer in return
1 cecill-2.1 cecill governed by the cecill license under french law
1 odbl-1.0 database made available under the open database license
1 odc-by-1.0 attribution made available under the open data commons attribution license
1 pddl-1.0 domain made available under the public domain dedication and license
1 upl-1.0 universal universal permissive license upl version 1 0
1 busl-1.1 business business source license 1 1( parameters)?
1 sspl-1.0 server server side public license version 1( october 16 2018)?
1 elastic-2.0 elastic licensed under the elastic license 2 0
1 elastic-2.0 elastic you may not use this file except in compliance with the elastic license
1 commons-clause commons the software is provided to you by the licensor under the license as defined below subject to the following condition( [^ ]+){0,6} commons clause
2 gpl-1.0 gnu gnu general public license( gpl)?( version| v)? 1( 0)?
2 gpl-2.0 gnu gnu general public license( gpl)?( version| v)? 2( 0)?
2 gpl-3.0 gnu gnu general public license( gpl)?( version| v)? 3( 0)?
2 gpl-2.0 gnu gnu general public license v2( 0)?
2 gpl-3.0 gnu gnu general public license v3( 0)?
2 gpl-2.0 gnu gnu gpl( version| v)? 2( 0)?
2 gpl-3.0 gnu gnu gpl( version| v)? 3( 0)?
2 gpl-2.0 gnu gnu gplv2
2 gpl-3.0 gnu gnu gplv3
2 gpl-2.0-or-later gplv2 gplv2 or( any)? later( version)?
2 gpl-3.0-or-later gplv3 gplv3 or( any)? later( version)?
2 gpl-2.0 gplv2 gplv2( 0)?
2 gpl-3.0 gplv3 gplv3( 0)?
2 gpl-2.0-or-later gpl gpl( version| v)? 2( 0)? or( any)? later( version)?
2 gpl-3.0-or-later gpl gpl( version| v)? 3( 0)? or( any)? later( version)?
2 gpl-2.0-only gpl gpl( version| v)? 2( 0)? only
2 gpl-3.0-only gpl gpl( version| v)? 3( 0)? only
2 gpl-2.0 gpl gpl( version| v)? 2( 0)?
2 gpl-3.0 gpl gpl( version| v)? 3( 0)?
2 lgpl-2.1 lesser gnu lesser general public license( lgpl)?( version| v)? 2 1
2 lgpl-3.0 lesser gnu lesser general public license( lgpl)?( version| v)? 3( 0)?
2 lgpl-2.1 lesser gnu lesser general public license v2 1
2 lgpl-3.0 lesser gnu lesser general public license v3( 0)?
2 lgpl-2.0 library gnu library general public license( lgpl)?( version| v)? 2( 0)?
2 lgpl-2.1-or-later lgpl lgpl( version| v)? 2 1 or( any)? later( version)?
2 lgpl-3.0-or-later lgpl lgpl( version| v)? 3( 0)? or( any)? later( version)?
2 lgpl-2.1-only lgpl lgpl( version| v)? 2 1 only
2 lgpl-3.0-only lgpl lgpl( version| v)? 3( 0)? only
2 lgpl-2.1 lgpl lgpl( version| v)? 2 1
2 lgpl-3.0 lgpl lgpl( version| v)? 3( 0)?
2 lgpl-2.1 lgplv2 lgplv2 1
2 lgpl-3.0 lgplv3 lgplv3( 0)?
2 agpl-3.0 affero gnu affero general public license( agpl)?( version| v)? 3( 0)?
2 agpl-3.0 affero gnu affero general public license v3( 0)?
2 agpl-3.0-or-later agpl agpl( version| v)? 3( 0)? or( any)? later( version)?
2 agpl-3.0-only agpl agpl( version| v)? 3( 0)? only
2 agpl-3.0 agpl agpl( version| v)? 3( 0)?
2 agpl-3.0 agplv3 agplv3( 0)?
2 gfdl-1.3 gnu gnu free documentation license( version| v)? 1 3
2 gfdl-1.2 gnu gnu free documentation license( version| v)? 1 2
2 gpl-2.0 licenses www gnu org licenses( old licenses)? gpl 2 0
2 gpl-3.0 licenses www gnu org licenses gpl 3 0
2 lgpl-2.1 licenses www gnu org licenses( old licenses)? lgpl 2 1
2 lgpl-3.0 licenses www gnu org licenses lgpl 3 0
2 agpl-3.0 licenses www gnu org licenses agpl 3 0
2 gpl licenses www gnu org licenses( gpl( html)?)?
2 gpl copyleft www gnu org copyleft gpl( html)?
2 gfdl licenses www gnu org licenses fdl( 1 [123])?
2 apache-2.0 apache apache license( software license)?( version| v)? 2( 0)?
2 apache-2.0 apache apache license v2( 0)?
2 apache-1.1 apache apache( software)? license( version| v)? 1 1
2 apache-1.0 apache apache( software)? license( version| v)? 1 0
2 apache-2.0 apache apache software license( version| v)? 2( 0)?
2 apache-2.0 apache apache 2( 0)?( license)?
2 apache-2.0 licenses www apache org licenses license 2 0
2 apache-2.0 asl asl( version| v)? 2( 0)?
2 mit licenses opensource org licenses mit( license)?( php)?
2 mit mit the mit license mit
2 mit mit mit x11( license)?
2 mit expat mit expat( license)?
2 mit expat expat license
2 x11 x11 x11 license
2 mit-0 mit mit no attribution( license)?
2 isc isc isc license
2 isc licenses opensource org licenses isc( license)?
2 bsd-2-clause bsd bsd 2 clause( license)?
2 bsd-2-clause bsd 2 clause bsd( license)?
2 bsd-2-clause bsd two clause bsd( license)?
2 bsd-2-clause simplified simplified bsd( license)?
2 bsd-2-clause freebsd freebsd license
2 bsd-3-clause bsd bsd 3 clause( license)?
2 bsd-3-clause bsd 3 clause bsd( license)?
2 bsd-3-clause bsd three clause bsd( license)?
2 bsd-3-clause bsd new bsd license
2 bsd-3-clause bsd modified bsd license
2 bsd-3-clause bsd revised bsd license
2 bsd-4-clause bsd bsd 4 clause( license)?
2 bsd-4-clause bsd original bsd license
2 bsd-2-clause licenses opensource org licenses bsd 2 clause
2 bsd-3-clause licenses opensource org licenses bsd 3 clause
2 0bsd 0bsd 0bsd( license)?
2 0bsd bsd (zero|0) clause bsd( license)?
2 mpl-2.0 mozilla mozilla public license( mpl)?( version| v)? 2( 0)?
2 mpl-2.0 mozilla mozilla public license v2( 0)?
2 mpl-1.1 mozilla mozilla public license( mpl)?( version| v)? 1 1
2 mpl-2.0 mozilla mozilla org mpl 2 0
2 mpl-2.0 mpl mpl( version| v)? 2 0
2 mpl-1.1 mpl mpl( version| v)? 1 1
2 epl-2.0 eclipse eclipse public license( epl)?( version| v)? 2( 0)?
2 epl-1.0 eclipse eclipse public license( epl)?( version| v)? 1( 0)?
2 epl-2.0 eclipse eclipse public license v2( 0)?
2 epl-1.0 eclipse eclipse public license v1( 0)?
2 epl-2.0 epl epl( version| v)? 2 0
2 epl-1.0 epl epl( version| v)? 1 0
2 edl-1.0 eclipse eclipse distribution license( version| v)? 1( 0)?
2 cddl-1.0 cddl cddl( version| v)? 1 0
2 cddl-1.1 cddl cddl( version| v)? 1 1
2 bsl-1.0 boost boost software license( version| v)?( 1 0)?
2 bsl-1.0 license boost org license 1 0( txt)?
2 zlib zlib zlib( libpng)? license
2 libpng libpng libpng license
2 artistic-2.0 artistic artistic license( version| v)? 2( 0)?
2 artistic-1.0 artistic artistic license( version| v)? 1( 0)?
2 cc-by-4.0 cc cc by( version| v)? 4 0( international)?
2 cc-by-3.0 cc cc by( version| v)? 3 0( unported| us)?
2 cc-by-2.5 cc cc by( version| v)? 2 5
2 cc-by-2.0 cc cc by( version| v)? 2 0
2 cc-by-sa-4.0 cc cc by sa( version| v)? 4 0( international)?
2 cc-by-sa-3.0 cc cc by sa( version| v)? 3 0( unported| us)?
2 cc-by-sa-2.5 cc cc by sa( version| v)? 2 5
2 cc-by-sa-2.0 cc cc by sa( version| v)? 2 0
2 cc-by-nd-4.0 cc cc by nd( version| v)? 4 0( international)?
2 cc-by-nc-4.0 cc cc by nc( version| v)? 4 0( international)?
2 cc-by-nc-3.0 cc cc by nc( version| v)? 3 0( unported| us)?
2 cc-by-nc-sa-4.0 cc cc by nc sa( version| v)? 4 0( international)?
2 cc-by-nc-sa-3.0 cc cc by nc sa( version| v)? 3 0( unported| us)?
2 cc-by-nc-nd-4.0 cc cc by nc nd( version| v)? 4 0( international)?
2 cc-by-nc-nd-3.0 cc cc by nc nd( version| v)? 3 0( unported| us)?
2 cc0-1.0 cc0 cc0( version| v)? 1 0( universal)?
2 cc-by-4.0 creativecommons creativecommons org licenses by 4 0
2 cc-by-3.0 creativecommons creativecommons org licenses by 3 0
2 cc-by-2.0 creativecommons creativecommons org licenses by 2 0
2 cc-by-sa-4.0 creativecommons creativecommons org licenses by sa 4 0
2 cc-by-sa-3.0 creativecommons creativecommons org licenses by sa 3 0
2 cc-by-nc-4.0 creativecommons creativecommons org licenses by nc 4 0
2 cc-by-nd-4.0 creativecommons creativecommons org licenses by nd 4 0
2 cc-by-nc-sa-4.0 creativecommons creativecommons org licenses by nc sa 4 0
2 cc-by-nc-nd-4.0 creativecommons creativecommons org licenses by nc nd 4 0
2 cc0-1.0 creativecommons creativecommons org publicdomain zero 1 0
2 cc-pdm-1.0 creativecommons creativecommons org publicdomain mark 1 0
2 cc-by-4.0 creative creative commons attribution( license)?( version| v)? 4 0( international)?( public)?( license)?
2 cc-by-3.0 creative creative commons attribution( license)?( version| v)? 3 0( unported)?( license)?
2 cc-by-sa-4.0 creative creative commons attribution share( )?alike( license)?( version| v)? 4 0( international)?( public)?( license)?
2 cc-by-sa-3.0 creative creative commons attribution share( )?alike( license)?( version| v)? 3 0( unported)?( license)?
2 cc-by-nc-4.0 creative creative commons attribution non( )?commercial( license)?( version| v)? 4 0( international)?( public)?( license)?
2 cc-by-nd-4.0 creative creative commons attribution no( )?derivatives( license)?( version| v)? 4 0( international)?( public)?( license)?
2 cc-by-nc-sa-4.0 creative creative commons attribution non( )?commercial share( )?alike( license)?( version| v)? 4 0( international)?( public)?( license)?
2 cc-by-nc-nd-4.0 creative creative commons attribution non( )?commercial no( )?derivatives( license)?( version| v)? 4 0( international)?( public)?( license)?
2 gpl-2.0-only spdx spdx license identifier gpl 2 0( only)?
2 gpl-2.0-or-later spdx spdx license identifier gpl 2 0 or later
2 gpl-3.0-only spdx spdx license identifier gpl 3 0( only)?
2 gpl-3.0-or-later spdx spdx license identifier gpl 3 0 or later
2 lgpl-2.1-only spdx spdx license identifier lgpl 2 1( only)?
2 lgpl-2.1-or-later spdx spdx license identifier lgpl 2 1 or later
2 lgpl-3.0-only spdx spdx license identifier lgpl 3 0( only)?
2 lgpl-3.0-or-later spdx spdx license identifier lgpl 3 0 or later
2 agpl-3.0-only spdx spdx license identifier agpl 3 0( only)?
2 agpl-3.0-or-later spdx spdx license identifier agpl 3 0 or later
2 apache-2.0 spdx spdx license identifier apache 2 0
2 mit spdx spdx license identifier mit
2 mit-0 spdx spdx license identifier mit 0
2 isc spdx spdx license identifier isc
2 0bsd spdx spdx license identifier 0bsd
2 bsd-2-clause spdx spdx license identifier bsd 2 clause
2 bsd-3-clause spdx spdx license identifier bsd 3 clause
2 bsd-4-clause spdx spdx license identifier bsd 4 clause
2 mpl-2.0 spdx spdx license identifier mpl 2 0
2 epl-2.0 spdx spdx license identifier epl 2 0
2 epl-1.0 spdx spdx license identifier epl 1 0
2 cddl-1.0 spdx spdx license identifier cddl 1 0
2 bsl-1.0 spdx spdx license identifier bsl 1 0
2 zlib spdx spdx license identifier zlib
2 unlicense spdx spdx license identifier unlicense
2 cc0-1.0 spdx spdx license identifier cc0 1 0
2 cc-by-4.0 spdx spdx license identifier cc by 4 0
2 cc-by-sa-4.0 spdx spdx license identifier cc by sa 4 0
2 cc-by-nc-4.0 spdx spdx license identifier cc by nc 4 0
2 ofl-1.1 spdx spdx license identifier ofl 1 1
2 wtfpl spdx spdx license identifier wtfpl
2 postgresql spdx spdx license identifier postgresql
2 sspl-1.0 spdx spdx license identifier sspl 1 0
2 busl-1.1 spdx spdx license identifier busl 1 1
2 elastic-2.0 spdx spdx license identifier elastic 2 0
2 artistic-2.0 spdx spdx license identifier artistic 2 0
2 eupl-1.2 spdx spdx license identifier eupl 1 2
2 python-2.0 python python software foundation license( version| v)?( 2( 0)?)?
2 ofl-1.1 sil sil open font license( version| v)?( 1 1)?
2 ms-pl microsoft microsoft public license( ms pl)?
2 ms-rl microsoft microsoft reciprocal license( ms rl)?
2 odbl-1.0 odbl odbl( version| v)?( 1 0)?
2 eupl-1.2 eupl eupl( version| v)? 1 2
2 eupl-1.1 eupl eupl( version| v)? 1 1
2 osl-3.0 open open software license( version| v)? 3 0
2 afl-3.0 academic academic free license( version| v)? 3 0
3 agpl affero (gnu )?affero general public license
3 lgpl lesser (gnu )?lesser general public license
3 lgpl library gnu library general public license
3 gfdl gnu gnu free documentation license
3 gpl gnu gnu public license
3 gpl gnu gnu gpl
3 gpl gpl gpl licen[cs]ed?
3 gpl gpl under( the)? gpl
3 lgpl lgpl lgpl
3 agpl agpl agpl
3 bsd bsd bsd( style)? licen[cs]ed?
3 bsd berkeley berkeley software distribution license
3 apache apache apache software license
3 apache apache apache licensed
3 mit mit mit licen[cs]ed
3 mit mit mit style licen[cs]e
3 mpl mozilla mozilla public licen[cs]e
3 epl eclipse eclipse public licen[cs]e
3 cpl common common public license
3 cddl distribution common development and distribution license
3 artistic artistic artistic licen[cs]e
3 boost boost boost license
3 unlicense unlicense (the )?unlicense
3 wtfpl wtfpl wtfpl
3 beerware beerware beerware( license)?
3 cc0 cc0 cc0
3 cc-by-sa cc cc by sa
3 cc-by-nd cc cc by nd
3 cc-by-nc cc cc by nc
3 cc-by-nc-sa cc cc by nc sa
3 cc-by-nc-nd cc cc by nc nd
3 cc-by-sa creative creative commons attribution share( )?alike
3 cc-by-nc creative creative commons attribution non( )?commercial
3 cc-by creative creative commons attribution
3 cc creative creative commons licen[cs]e
3 cc creative under( a| the)? creative commons
3 ofl font open font license
3 odbl database open database license
3 sspl server server side public license
3 busl business business source license
3 elastic elastic elastic license
3 eupl eupl eupl
3 eupl european european union public licen[cs]e
3 cecill cecill cecill
3 public-domain domain (in|into) the public domain
3 public-domain domain public domain (dedication|work)
3 commercial commercial commercial license
3 proprietary proprietary proprietary (license|software|and confidential)
3 proprietary confidential confidential and proprietary
9 all-rights-reserved reserved all rights reserved
9 unknown licensed licensed under( the| a| an)?( terms of)?
9 unknown released released under( the| a| an)?( terms of( the)?)?( [^ ]+){0,3} licen[cs]e
9 unknown distributed distributed under( the| a| an)?( terms of( the)?)?( [^ ]+){0,3} licen[cs]e
9 unknown license (see|read)( the)? license( file)?( for details)?
9 unknown license license agreement
9 unknown license open source license
9 unknown license free software license
9 unknown license subject to( the)?( terms of)?( the| this)? license
9 unknown licence under( the| a| an)?( [^ ]+){0,3} licence
9 unknown redistribute may (not )?redistribute
9 unknown copyrighted copyrighted material
"""


def _rule(line: str) -> Rule:
    priority, label, keyword, pattern = line.split(" ", 3)
    return Rule(int(priority), label, keyword, pattern)


RULES: list[Rule] = BASE + [_rule(line) for line in _WRITTEN.strip().splitlines()]


def pattern_of(rule: Rule) -> str:
    """The rule's pattern over words that each stand between spaces of their own (" a  b ")."""
    return " " + rule.pattern.replace(" ", "  ") + " "


def keyword_pattern() -> str:
    """One pattern for all keywords, by first letter, so that most words fail at once. Only the space before a word is tried."""
    by_letter: dict[str, list[str]] = {}
    for keyword in sorted({r.keyword for r in RULES}):
        by_letter.setdefault(keyword[0], []).append(keyword[1:])
    # Longer endings first: the space after them decides anyway.
    return " (?! )(" + "|".join(f"{c}(?:{'|'.join(sorted(rest, key=len, reverse=True))})" for c, rest in by_letter.items()) + ") "
