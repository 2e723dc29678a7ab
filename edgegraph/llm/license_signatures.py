"""Hand-written licence signatures: identifiers, and passages of notices and licence texts.

All patterns are over normalised words (lower case, one space between words, punctuation gone; see ``license_scan.normalise``).
"""

from __future__ import annotations

# SPDX licence identifiers as normalised words, and their label. "gpl 2 0" also stands for "GPL-2.0+".
GNU_SUFFIX = "(?: only| or later)?"
SPDX_IDS = (
    ("apache 1 0", "apache-1.0"), ("apache 1 1", "apache-1.1"), ("apache 2 0", "apache-2.0"),
    ("mit", "mit"), ("mit 0", "mit-0"), ("x11", "x11"), ("isc", "isc"), ("0bsd", "bsd-0-clause"),
    ("bsd 1 clause", "bsd-1-clause"), ("bsd 2 clause", "bsd-2-clause"), ("bsd 3 clause", "bsd-3-clause"),
    ("bsd 4 clause", "bsd-4-clause"), ("bsd 2 clause patent", "bsd-2-clause-patent"),
    ("gpl 1 0" + GNU_SUFFIX, "gpl-1.0"), ("gpl 2 0" + GNU_SUFFIX, "gpl-2.0"), ("gpl 3 0" + GNU_SUFFIX, "gpl-3.0"),
    ("lgpl 2 0" + GNU_SUFFIX, "lgpl-2.0"), ("lgpl 2 1" + GNU_SUFFIX, "lgpl-2.1"), ("lgpl 3 0" + GNU_SUFFIX, "lgpl-3.0"),
    ("agpl 1 0" + GNU_SUFFIX, "agpl-1.0"), ("agpl 3 0" + GNU_SUFFIX, "agpl-3.0"),
    ("gfdl 1 1" + GNU_SUFFIX, "gfdl-1.1"), ("gfdl 1 2" + GNU_SUFFIX, "gfdl-1.2"), ("gfdl 1 3" + GNU_SUFFIX, "gfdl-1.3"),
    ("mpl 1 0", "mpl-1.0"), ("mpl 1 1", "mpl-1.1"), ("mpl 2 0", "mpl-2.0"), ("epl 1 0", "epl-1.0"), ("epl 2 0", "epl-2.0"),
    ("cddl 1 0", "cddl-1.0"), ("cddl 1 1", "cddl-1.1"), ("cpl 1 0", "cpl-1.0"), ("ipl 1 0", "ipl-1.0"),
    ("eupl 1 1", "eupl-1.1"), ("eupl 1 2", "eupl-1.2"), ("artistic 1 0", "artistic-1.0"), ("artistic 2 0", "artistic-2.0"),
    ("bsl 1 0", "bsl-1.0"), ("zlib", "zlib"), ("libpng 2 0", "libpng-2.0"), ("ofl 1 0", "ofl-1.0"), ("ofl 1 1", "ofl-1.1"),
    ("odbl 1 0", "odbl-1.0"), ("odc by 1 0", "odc-by-1.0"), ("pddl 1 0", "pddl-1.0"), ("psf 2 0", "psf-2.0"),
    ("python 2 0", "psf-2.0"), ("php 3 0", "php-3.0"), ("php 3 01", "php-3.01"), ("ruby", "ruby"), ("wtfpl", "wtfpl"),
    ("unlicense", "unlicense"), ("cc0 1 0", "cc0-1.0"),
    ("cc by 2 0", "cc-by-2.0"), ("cc by 3 0", "cc-by-3.0"), ("cc by 4 0", "cc-by-4.0"),
    ("cc by sa 3 0", "cc-by-sa-3.0"), ("cc by sa 4 0", "cc-by-sa-4.0"), ("cc by nc 4 0", "cc-by-nc-4.0"),
    ("cc by nd 4 0", "cc-by-nd-4.0"), ("cc by nc sa 4 0", "cc-by-nc-sa-4.0"), ("cc by nc nd 4 0", "cc-by-nc-nd-4.0"),
    ("ms pl", "ms-pl"), ("ms rl", "ms-rl"), ("ncsa", "ncsa"), ("postgresql", "postgresql"), ("openssl", "openssl"),
    ("w3c", "w3c"), ("upl 1 0", "upl-1.0"), ("blueoak 1 0 0", "blueoak-1.0.0"), ("curl", "curl"), ("ftl", "ftl"),
    ("afl 3 0", "afl-3.0"), ("osl 3 0", "osl-3.0"), ("apsl 2 0", "apsl-2.0"), ("ecl 2 0", "ecl-2.0"), ("vim", "vim"),
    ("sleepycat", "sleepycat"), ("sspl 1 0", "sspl-1.0"), ("busl 1 1", "busl-1.1"), ("elastic 2 0", "elastic-2.0"),
    ("mulanpsl 2 0", "mulanpsl-2.0"), ("hpnd", "hpnd"), ("json", "json"), ("beerware", "beerware"), ("zpl 2 1", "zpl-2.1"),
    ("cecill 2 1", "cecill-2.1"), ("oldap 2 8", "oldap-2.8"), ("cdla permissive 2 0", "cdla-permissive-2.0"),
)

# Fixed values: (label, keyword that is part of every match, pattern); passages of notices, texts, headers and URLs.
SIGNATURES = (
    # MIT and its kin
    ("mit", " permission is hereby granted free of charge to any person obtaining",
     "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("mit", " this permission notice shall be included",
     "(?:the above copyright notice and )?this permission notice shall be included in all copies or substantial portions of the software"),
    ("mit", " opensource org licenses mit", "opensource org licenses mit(?: license php)?"),
    ("x11", " shall not be used in advertising or otherwise to promote the sale",
     "shall not be used in advertising or otherwise to promote the sale use or other dealings in this software"),
    ("json", " shall be used for good not evil", "the software shall be used for good not evil"),
    ("isc", " permission to use copy modify and", "permission to use copy modify and(?: or)? distribute this software for any purpose "
     "with or without fee is hereby granted"),
    ("hpnd", " permission to use copy modify", "permission to use copy modify(?: and)? distribute(?: and sell)? this software and its "
     "documentation for any purpose (?:is hereby granted without fee|and without fee is hereby granted)"),
    ("postgresql", " permission to use copy modify", "permission to use copy modify and distribute this software and its documentation "
     "for any purpose without fee and without a written agreement is hereby granted"),
    ("ncsa", " university of illinois ncsa open source licen", "university of illinois ncsa open source licen[sc]e"),
    # BSD
    ("bsd", " redistribution and use in source and binary forms", "redistribution and use in source and binary forms with or without "
     "modification are permitted provided that the following conditions are met"),
    ("bsd", " redistributions of source code must retain", "redistributions of source code must retain the above copyright notice"),
    ("bsd", " redistributions in binary form must reproduce", "redistributions in binary form must reproduce the above copyright notice"),
    ("bsd-3-clause", " may be used to endorse or promote products", "(?:nor the )?names of (?:its|the) contributors may be used to endorse "
     "or promote products derived from this software"),
    ("bsd-4-clause", " all advertising materials mentioning features", "all advertising materials mentioning features or use of this "
     "software must display the following acknowledge?ment"),
    ("bsd", " opensource org licenses bsd", "opensource org licenses bsd licen[sc]e(?: php)?"),
    ("openssl", " developed by the openssl project", "this product includes software developed by the openssl project"),
    # Apache
    ("apache-2.0", " you may not use this file except in compliance with the licen", "you may not use this file except in compliance "
     "with the licen[sc]e"),
    ("apache-2.0", " software distributed under the licen", "software distributed under the licen[sc]e is distributed on an as is basis"),
    ("apache-2.0", " apache org licenses license 2 0", "apache org licenses license 2 0"),
    ("apache-2.0", " each contributor hereby grants to you", "subject to the terms and conditions of this licen[sc]e each contributor "
     "hereby grants to you a perpetual worldwide non exclusive no charge royalty free irrevocable (?:copyright|patent) licen[sc]e"),
    ("apache-2.0", " licensed to the apache software foundation", "licensed to the apache software foundation asf under one or more "
     "contributor licen[sc]e agreements"),
    ("apache-1.1", " developed by the apache software foundation", "this product includes software developed by the apache software foundation"),
    # GNU
    ("gpl-2.0", " gnu general public license as published", "gnu general public license as published by the free software foundation "
     "(?:either )?version 2 of the license"),
    ("gpl-3.0", " gnu general public license as published", "gnu general public license as published by the free software foundation "
     "(?:either )?version 3 of the license"),
    ("lgpl-2.1", " gnu lesser general public license as published", "gnu lesser general public license as published by the free software "
     "foundation (?:either )?version 2 1 of the license"),
    ("lgpl-3.0", " gnu lesser general public license as published", "gnu lesser general public license as published by the free software "
     "foundation (?:either )?version 3 of the license"),
    ("lgpl-2.0", " gnu library general public license as published", "gnu library general public license as published by the free software "
     "foundation (?:either )?version 2 of the license"),
    ("agpl-3.0", " gnu affero general public license as published", "gnu affero general public license as published by the free software "
     "foundation (?:either )?version 3 of the license"),
    ("gpl", " received a copy of the gnu general public license", "you should have received a copy of the gnu general public license"),
    ("lgpl", " received a copy of the gnu lesser general public license", "you should have received a copy of the gnu lesser general public license"),
    ("agpl", " received a copy of the gnu affero general public license", "you should have received a copy of the gnu affero general public license"),
    ("gpl-2.0", " the licenses for most software are designed", "the licenses for most software are designed to take away your freedom to "
     "share and change it by contrast the gnu general public license"),
    ("gpl-3.0", " the gnu general public license is a free copyleft license", "the gnu general public license is a free copyleft license for "
     "software and other kinds of works"),
    ("agpl-3.0", " the gnu affero general public license is a free copyleft license", "the gnu affero general public license is a free "
     "copyleft license for software and other kinds of works"),
    ("lgpl-3.0", " incorporates the terms and conditions of version 3", "this version of the gnu lesser general public license incorporates "
     "the terms and conditions of version 3 of the gnu general public license"),
    ("gpl-2.0", " gnu org licenses old licenses gpl 2 0", "gnu org licenses old licenses gpl 2 0(?: html| txt)?"),
    ("gpl-3.0", " gnu org licenses gpl 3 0", "gnu org licenses gpl 3 0(?: html| txt)?"),
    ("gpl", " gnu org licenses gpl", "gnu org licenses gpl(?: html| txt)?"),
    ("lgpl-2.1", " gnu org licenses old licenses lgpl 2 1", "gnu org licenses old licenses lgpl 2 1(?: html| txt)?"),
    ("lgpl-3.0", " gnu org licenses lgpl 3 0", "gnu org licenses lgpl 3 0(?: html| txt)?"),
    ("agpl-3.0", " gnu org licenses agpl 3 0", "gnu org licenses agpl 3 0(?: html| txt)?"),
    ("gfdl-1.3", " gnu org licenses fdl 1 3", "gnu org licenses fdl 1 3(?: html| txt)?"),
    ("gfdl-1.1", " under the terms of the gnu free documentation license version 1 1", "copy distribute and or modify this document under "
     "the terms of the gnu free documentation license version 1 1"),
    ("gfdl-1.2", " under the terms of the gnu free documentation license version 1 2", "copy distribute and or modify this document under "
     "the terms of the gnu free documentation license version 1 2"),
    ("gfdl-1.3", " under the terms of the gnu free documentation license version 1 3", "copy distribute and or modify this document under "
     "the terms of the gnu free documentation license version 1 3"),
    # other reciprocal licences
    ("mpl-2.0", " subject to the terms of the mozilla public licen", "this source code form is subject to the terms of the mozilla public "
     "licen[sc]e v 2 0"),
    ("mpl-1.1", " contents of this file are subject to the mozilla public licen", "contents of this file are subject to the mozilla public "
     "licen[sc]e version 1 1"),
    ("mpl-2.0", " mozilla org mpl 2 0", "mozilla org mpl 2 0"),
    ("epl-1.0", " under the terms of the eclipse public license v 1 0", "made available under the terms of the eclipse public license v 1 0"),
    ("epl-2.0", " under the terms of the eclipse public license 2 0", "made available under the terms of the eclipse public license 2 0"),
    ("epl-1.0", " eclipse org legal epl v10", "eclipse org legal epl v10(?: html)?"),
    ("epl-2.0", " eclipse org legal epl 2 0", "eclipse org legal epl 2 0(?: html)?"),
    ("cddl", " subject to the terms of the common development and distribution licen", "contents of this file are subject to the terms of "
     "the common development and distribution licen[sc]e"),
    ("cpl-1.0", " the accompanying program is provided under the terms of this common public licen", "the accompanying program is provided "
     "under the terms of this common public licen[sc]e"),
    ("eupl", " licensed under the eupl", "licensed under the eupl"),
    ("artistic-1.0", " conditions under which a package may be copied", "the intent of this document is to state the conditions under which "
     "a package may be copied"),
    ("sspl-1.0", " server side public licen", "server side public licen[sc]e(?: version 1| v1)?"),
    ("osl", " open software licen", "(?:licensed under the )?open software licen[sc]e"),
    ("afl", " academic free licen", "(?:licensed under the )?academic free licen[sc]e"),
    ("qpl", " q public licen", "(?:the )?q public licen[sc]e"),
    ("ipl-1.0", " ibm public licen", "ibm public licen[sc]e"),
    ("apsl", " apple public source licen", "apple public source licen[sc]e"),
    ("zpl", " zope public licen", "zope public licen[sc]e"),
    ("oldap", " openldap public licen", "(?:the )?openldap public licen[sc]e"),
    ("ms-pl", " microsoft public licen", "microsoft public licen[sc]e(?: ms pl)?"),
    ("ms-rl", " microsoft reciprocal licen", "microsoft reciprocal licen[sc]e(?: ms rl)?"),
    ("upl-1.0", " universal permissive licen", "(?:the )?universal permissive licen[sc]e"),
    ("mulanpsl", " mulan permissive software licen", "mulan permissive software licen[sc]e"),
    ("ftl", " freetype project licen", "(?:the )?freetype project licen[sc]e"),
    ("vim", " vim licen", "vim licen[sc]e"),
    ("w3c", " w3c software notice and licen", "w3c software notice and licen[sc]e"),
    ("psf", " psf license agreement for python", "psf license agreement for python"),
    ("beerware", " beer in return", "you can buy me a beer in return"),
    # permissive passages
    ("bsl-1.0", " permission is hereby granted free of charge to any person or organization", "permission is hereby granted free of charge to "
     "any person or organization obtaining a copy of the software and accompanying documentation covered by this licen[sc]e"),
    ("bsl-1.0", " boost org license 1 0", "boost org license 1 0(?: txt)?"),
    ("zlib", " without any express or implied warranty in no event will the authors", "provided as is without any express or implied warranty "
     "in no event will the authors be held liable for any damages arising from the use of this software"),
    ("zlib", " altered source versions must be plainly marked", "altered source versions must be plainly marked as such"),
    ("unlicense", " free and unencumbered software", "this is free and unencumbered software released into the public domain"),
    ("unlicense", " unlicense org", "unlicense org"),
    ("wtfpl", " do what the fuck you want to public licen", "do what the fuck you want to public licen[sc]e"),
    # content and data
    ("cc0-1.0", " creative commons zero", "creative commons zero(?: v1 0 universal)?"),
    ("cc0-1.0", " creative commons cc0", "creative commons cc0"),
    ("cc0-1.0", " creativecommons org publicdomain zero", "creativecommons org publicdomain zero 1 0"),
    ("cc0-1.0", " related or neighboring rights", "waived all copyright and related or neighboring rights to"),
    ("public-domain", " creativecommons org publicdomain mark", "creativecommons org publicdomain mark 1 0"),
    ("ofl-1.1", " this font software is licensed under the sil open font", "this font software is licensed under the sil open font licen[sc]e "
     "version 1 1"),
    ("odbl-1.0", " opendatacommons org licenses odbl", "opendatacommons org licenses odbl(?: 1 0| summary)?"),
    ("odc-by-1.0", " opendatacommons org licenses by", "opendatacommons org licenses by(?: 1 0)?"),
    ("pddl-1.0", " public domain dedication and licen", "public domain dedication and licen[sc]e"),
    ("cdla-permissive", " community data license agreement permissive", "community data license agreement permissive"),
    ("cdla-sharing", " community data license agreement sharing", "community data license agreement sharing"),
    ("ogl", " open government licen", "open government licen[sc]e(?: v3 0| v2 0| v1 0)?"),
    # source-available, models, proprietary
    ("busl-1.1", " business source licen", "business source licen[sc]e(?: 1 1)?"),
    ("elastic-2.0", " elastic license 2 0", "elastic license 2 0"),
    ("commons-clause", " commons clause licen", "commons clause licen[sc]e condition"),
    ("rail", " responsible ai licen", "responsible ai licen[sc]e"),
    ("openrail", " openrail m licen", "openrail m licen[sc]e"),
    ("llama-community", " community license agreement", "llama [234] community license agreement"),
    ("proprietary", " unauthorized copying of this file", "unauthorized copying of this file via any medium is strictly prohibited"),
    ("proprietary", " no part of this publication may be reproduced", "no part of this publication may be reproduced"),
)

# Creative Commons licences by address: every combination of terms has one.
CC_TERMS = ("by", "by sa", "by nc", "by nd", "by nc sa", "by nc nd")
CC_VERSIONS = ("1.0", "2.0", "2.5", "3.0", "4.0")
