"""Signature rules of the license scan: hand-written regexes over normalised text.

Normalised text is lower-cased (A-Z); every run of characters other than letters, digits,
``.``, ``+``, ``/``, ``:`` and ``-`` is one space. Rules are ordered; a rule is
``(label, level, keyword, pattern)`` and is tried only where its keyword and one of the pattern's
own :func:`literals` occur. Levels, from weak to strong: 1 a mention, 2 a licence's name, 3 a notice or grant, 4 a machine-readable tag.
"""

from __future__ import annotations

from re import _parser

MENTION, NAME, NOTICE, TAG = 1, 2, 3, 4
LEVELS = 4

#: Every match holds its rule's keyword and one of these; texts with none of them are not scanned at all.
ANCHORS = ("licen", "copyright", "reserved", "domain", "spdx", "gpl", "warrant", "commons", "redistribut", "permission",
           "copyleft", "proprietary", "confidential", "cc0", "cc-by", "cc by", "unlicense", "trademark", "wtfpl",
           "imatix", "mulan", "nasa open source", "may be used for")

# label, how the licence is called, and its SPDX identifiers
_FAMILIES = [
    ("0bsd", r"(zero[ -]clause bsd|bsd zero clause|0bsd|free public) licen[sc]e", r"0bsd"),
    ("aal", r"attribution assurance licen[sc]e", r"aal"),
    ("abstyles", r"abstyles licen[sc]e", r"abstyles"),
    ("adobe-2006", r"adobe systems incorporated source code licen[sc]e", r"adobe-2006"),
    ("afl", r"academic free licen[sc]e( (v|version )?\.? ?[123]\.[0-2])?", r"afl-[123]\.[0-2]"),
    ("agpl", r"(gnu )?affero general public licen[sc]e( (v|version )?\.? ?[123](\.0)?)?|agpl ?-?v?[123](\.0)? licen[sc]e", r"agpl-[123]\.0(-only|-or-later|\+)?"),
    ("aladdin", r"aladdin free public licen[sc]e", r"aladdin"),
    ("amdplpa", r"amd.?s plpa\.map licen[sc]e", r"amdplpa"),
    ("apache", r"apache (software )?licen[sc]e( (v|version )?\.? ?[12](\.[01])?)?", r"apache-[12]\.[01]"),
    ("apafml", r"adobe postscript afm licen[sc]e", r"apafml"),
    ("apl", r"adaptive public licen[sc]e( 1\.0)?", r"apl-1\.0"),
    ("apsl", r"apple public source licen[sc]e( (version )?[12]\.[0-2])?", r"apsl-[12]\.[0-2]"),
    ("artistic", r"(perl )?artistic licen[sc]e( (v|version )?\.? ?[12]\.0)?|clarified artistic licen[sc]e", r"(cl)?artistic(-[12]\.0(-cl8|-perl)?)?"),
    ("barr", r"barr licen[sc]e", r"barr"),
    ("beerware", r"beer-?ware licen[sc]e", r"beerware"),
    ("bittorrent", r"bittorrent open source licen[sc]e( 1\.[01])?", r"bittorrent-1\.[01]"),
    ("blueoak", r"blue oak model licen[sc]e( 1\.0\.0)?", r"blueoak-1\.0\.0"),
    ("borceux", r"borceux licen[sc]e", r"borceux"),
    ("bsd-1", r"(bsd 1[ -]clause|1[ -]clause bsd) licen[sc]e", r"bsd-1-clause"),
    ("bsd-2", r"(simplified|freebsd|bsd 2[ -]clause|2[ -]clause bsd|bsd two[ -]clause|two[ -]clause bsd) licen[sc]e", r"bsd-2-clause(-patent|-views|-freebsd)?"),
    ("bsd-3", r"(new bsd|modified bsd|revised bsd|bsd 3[ -]clause|3[ -]clause bsd|bsd three[ -]clause|three[ -]clause bsd) licen[sc]e", r"bsd-3-clause(-clear|-lbnl|-attribution)?"),
    ("bsd-4", r"(original bsd|old bsd|bsd 4[ -]clause|4[ -]clause bsd|four[ -]clause bsd) licen[sc]e", r"bsd-4-clause(-uc)?"),
    ("bsd", r"bsd[ -](style )?licen[sc]e", r"bsd"),
    ("bsl", r"boost software licen[sc]e( (v|version )?\.? ?1\.0)?", r"bsl-1\.0"),
    ("busl", r"business source licen[sc]e( 1\.1)?", r"busl-1\.1"),
    ("bzip2", r"bzip2( and libbzip2)? licen[sc]e", r"bzip2-1\.0\.[56]"),
    ("caldera", r"caldera licen[sc]e", r"caldera"),
    ("catosl", r"computer associates trusted open source licen[sc]e( 1\.1)?", r"catosl-1\.1"),
    ("cc-by-nc-nd", r"attribution[ -]non-?commercial[ -]no-?deriv(ative)?s?( works)? [1-4]\.[05]( (international|unported|generic))? licen[sc]e", r"cc-by-nc-nd-[1-4]\.[05]"),
    ("cc-by-nc-sa", r"attribution[ -]non-?commercial[ -]share-? ?alike [1-4]\.[05]( (international|unported|generic))? licen[sc]e", r"cc-by-nc-sa-[1-4]\.[05]"),
    ("cc-by-nc", r"attribution[ -]non-?commercial [1-4]\.[05]( (international|unported|generic))? licen[sc]e", r"cc-by-nc-[1-4]\.[05]"),
    ("cc-by-nd", r"attribution[ -]no-?deriv(ative)?s?( works)? [1-4]\.[05]( (international|unported|generic))? licen[sc]e", r"cc-by-nd-[1-4]\.[05]"),
    ("cc-by-sa", r"attribution[ -]share-? ?alike [1-4]\.[05]( (international|unported|generic))? licen[sc]e", r"cc-by-sa-[1-4]\.[05]"),
    ("cc-by", r"creative commons attribution( [1-4]\.[05]( (international|unported|generic))?)? licen[sc]e", r"cc-by-[1-4]\.[05]"),
    ("cc0", r"cc0( 1\.0)?( universal)?( public domain)? (licen[sc]e|dedication)", r"cc0-1\.0"),
    ("cddl", r"common development and distribution licen[sc]e( (v|version )?\.? ?1\.[01])?", r"cddl-1\.[01]"),
    ("cdla", r"community data licen[sc]e agreement", r"cdla-(permissive|sharing)-[12]\.0"),
    ("cecill", r"cecill(-[bc])?( free software)? licen[sc]e( agreement)?", r"cecill-([bc]|[12]\.[01])"),
    ("clear-bsd", r"clear bsd licen[sc]e", r"bsd-3-clause-clear"),
    ("cnri-python", r"cnri python( open source( gpl compatible)?)? licen[sc]e( agreement)?", r"cnri-python(-gpl-compatible)?"),
    ("condor", r"condor public licen[sc]e", r"condor-1\.1"),
    ("cpal", r"common public attribution licen[sc]e( (version )?1\.0)?", r"cpal-1\.0"),
    ("cpl", r"common public licen[sc]e( (v|version )?\.? ?1\.0)?", r"cpl-1\.0"),
    ("cpol", r"code project open licen[sc]e( 1\.02)?", r"cpol-1\.02"),
    ("cua-opl", r"cua office public licen[sc]e( 1\.0)?", r"cua-opl-1\.0"),
    ("curl", r"curl licen[sc]e", r"curl"),
    ("diffmark", r"diffmark licen[sc]e", r"diffmark"),
    ("doc", r"doc software licen[sc]e", r"doc"),
    ("dotseqn", r"dotseqn licen[sc]e", r"dotseqn"),
    ("dsdp", r"dsdp licen[sc]e", r"dsdp"),
    ("ecl", r"educational community licen[sc]e( (v|version )?\.? ?[12]\.0)?", r"ecl-[12]\.0"),
    ("efl", r"eiffel forum licen[sc]e( (v|version )?\.? ?[12](\.0)?)?", r"efl-[12]\.0"),
    ("egenix", r"egenix\.com public licen[sc]e( agreement)?", r"egenix"),
    ("elastic", r"elastic licen[sc]e( (v|version )?\.? ?[12](\.0)?)?", r"elastic-2\.0"),
    ("entessa", r"entessa public licen[sc]e", r"entessa"),
    ("epl", r"eclipse public licen[sc]e( (v|version )?\.? ?[12]\.0)?", r"epl-[12]\.0"),
    ("erlpl", r"erlang public licen[sc]e", r"erlpl-1\.1"),
    ("eudatagrid", r"eu datagrid software licen[sc]e", r"eudatagrid"),
    ("eupl", r"european union public licen[sc]e( (v|version )?\.? ?1\.[012])?", r"eupl-1\.[012]"),
    ("eurosym", r"eurosym licen[sc]e", r"eurosym"),
    ("fair", r"fair licen[sc]e", r"fair"),
    ("frameworx", r"frameworx open licen[sc]e( 1\.0)?", r"frameworx-1\.0"),
    ("freetype", r"freetype (project )?licen[sc]e", r"ftl"),
    ("fsfap", r"fsf all permissive licen[sc]e", r"fsfap"),
    ("gfdl", r"(gnu )?free documentation licen[sc]e( (v|version )?\.? ?1\.[123])?", r"gfdl-1\.[123](-only|-or-later)?"),
    ("giftware", r"giftware licen[sc]e", r"giftware"),
    ("gl2ps", r"gl2ps licen[sc]e", r"gl2ps"),
    ("glide", r"3dfx glide licen[sc]e", r"glide"),
    ("gpl", r"gnu general public licen[sc]e( (v|version )?\.? ?[123](\.0)?)?|(gnu )?gpl ?-?v?[123](\.0)?( or later)? licen[sc]e", r"gpl-[123]\.0(-only|-or-later|\+)?"),
    ("gsoap", r"gsoap public licen[sc]e( (version )?1\.3b?)?", r"gsoap-1\.3b"),
    ("hpnd", r"historical permission notice and disclaimer", r"hpnd"),
    ("ibm-pibs", r"ibm powerpc initialization and boot software licen[sc]e", r"ibm-pibs"),
    ("icu", r"icu licen[sc]e", r"icu"),
    ("ijg", r"independent jpeg group licen[sc]e", r"ijg"),
    ("imagemagick", r"imagemagick licen[sc]e", r"imagemagick"),
    ("imatix", r"imatix standard function library (licen[sc]e )?agreement", r"imatix"),
    ("imlib2", r"imlib2 licen[sc]e", r"imlib2"),
    ("info-zip", r"info-zip licen[sc]e", r"info-zip"),
    ("intel", r"intel open source licen[sc]e", r"intel"),
    ("ipa", r"ipa font licen[sc]e( agreement)?", r"ipa"),
    ("ipl", r"ibm public licen[sc]e( (v|version )?\.? ?1\.0)?", r"ipl-1\.0"),
    ("isc", r"isc licen[sc]e", r"isc"),
    ("jasper", r"jasper licen[sc]e( version 2\.0)?", r"jasper-2\.0"),
    ("json", r"json licen[sc]e", r"json"),
    ("lal", r"(free art licen[sc]e|licence art libre)( 1\.[23])?", r"lal-1\.[23]"),
    ("latex2e", r"latex2e licen[sc]e", r"latex2e"),
    ("leptonica", r"leptonica licen[sc]e", r"leptonica"),
    ("lgpl", r"(gnu )?(lesser|library) general public licen[sc]e( (v|version )?\.? ?[23](\.[01])?)?|lgpl ?-?v?[23](\.[01])?( or later)? licen[sc]e", r"lgpl-[23]\.[01](-only|-or-later|\+)?"),
    ("libpng", r"libpng licen[sc]e", r"libpng(-2\.0)?"),
    ("libtiff", r"libtiff licen[sc]e", r"libtiff"),
    ("liliq", r"licence libre du quebec", r"liliq-(p|r|rplus)-1\.1"),
    ("lppl", r"latex project public licen[sc]e( (v|version )?\.? ?1\.[0-3][ac]?)?", r"lppl-1\.[0-3][ac]?"),
    ("lucent", r"lucent public licen[sc]e( (v|version )?\.? ?1\.0(2)?)?", r"lpl-1\.0(2)?"),
    ("miros", r"miros licen[sc]e", r"miros"),
    ("mit", r"(the )?mit( open source)? licen[sc]e|licen[sc]ed under (the )?mit|expat licen[sc]e|x11 licen[sc]e", r"mit(-0|-cmu|-enna|-feh)?"),
    ("motosoto", r"motosoto (open source )?licen[sc]e", r"motosoto"),
    ("mpl", r"mozilla public licen[sc]e( (v|version )?\.? ?[12]\.[01])?", r"mpl-[12]\.[01](-no-copyleft-exception)?"),
    ("ms-pl", r"microsoft public licen[sc]e", r"ms-pl"),
    ("ms-rl", r"microsoft reciprocal licen[sc]e", r"ms-rl"),
    ("mtll", r"matrix template library licen[sc]e", r"mtll"),
    ("mulan", r"mulan (psl|permissive software licen[sc]e)( (v|version )?\.? ?[12])?", r"mulanpsl-[12]\.0"),
    ("multics", r"multics licen[sc]e", r"multics"),
    ("nasa", r"nasa open source agreement( 1\.3)?", r"nasa-1\.3"),
    ("naumen", r"naumen public licen[sc]e", r"naumen"),
    ("ncsa", r"(university of illinois|ncsa)[ /]*(ncsa )?open source licen[sc]e", r"ncsa"),
    ("netcdf", r"netcdf licen[sc]e", r"netcdf"),
    ("ngpl", r"nethack general public licen[sc]e", r"ngpl"),
    ("nokia", r"nokia open source licen[sc]e", r"nokia"),
    ("npl", r"netscape public licen[sc]e( (v|version )?\.? ?1\.[01])?", r"npl-1\.[01]"),
    ("nposl", r"non-profit open software licen[sc]e( 3\.0)?", r"nposl-3\.0"),
    ("oclc", r"oclc research public licen[sc]e( 2\.0)?", r"oclc-2\.0"),
    ("odbl", r"open (data commons open )?database licen[sc]e", r"odbl-1\.0"),
    ("odc-by", r"open data commons attribution licen[sc]e", r"odc-by-1\.0"),
    ("ofl", r"sil open font licen[sc]e( (v|version )?\.? ?1\.[01])?", r"ofl-1\.[01](-rfn|-no-rfn)?"),
    ("ogl", r"open government licen[sc]e( (v|version )?\.? ?[123](\.0)?)?", r"ogl-uk-[123]\.0"),
    ("ogtsl", r"open group test suite licen[sc]e", r"ogtsl"),
    ("oldap", r"openldap public licen[sc]e( (v|version )?\.? ?[12]\.[0-8])?", r"oldap-[12]\.[0-8]"),
    ("openssl", r"openssl( and ssleay)? licen[sc]e", r"openssl"),
    ("osl", r"open software licen[sc]e( (v|version )?\.? ?[123]\.[01])?", r"osl-[123]\.[01]"),
    ("pddl", r"public domain dedication (and|&) licen[sc]e", r"pddl-1\.0"),
    ("php", r"php licen[sc]e( (v|version )?\.? ?3\.0[1]?)?", r"php-3\.0[1]?"),
    ("plexus", r"plexus classworlds licen[sc]e", r"plexus"),
    ("polyform", r"polyform (noncommercial|small business|strict|shield|perimeter)? ?licen[sc]e( 1\.0\.0)?", r"polyform-[a-z-]+-1\.0\.0"),
    ("postgresql", r"postgresql licen[sc]e", r"postgresql"),
    ("psf", r"python software foundation licen[sc]e( (v|version )?\.? ?2)?", r"(psf|python)-2\.0"),
    ("qpl", r"q public licen[sc]e( (v|version )?\.? ?1\.0)?", r"qpl-1\.0"),
    ("rpl", r"reciprocal public licen[sc]e( (v|version )?\.? ?1\.[15])?", r"rpl-1\.[15]"),
    ("rpsl", r"realnetworks public source licen[sc]e( (v|version )?\.? ?1\.0)?", r"rpsl-1\.0"),
    ("ruby", r"ruby licen[sc]e", r"ruby"),
    ("saxpath", r"saxpath licen[sc]e", r"saxpath"),
    ("scea", r"scea shared source licen[sc]e", r"scea"),
    ("sgi-b", r"sgi free software licen[sc]e( b)?( (v|version )?\.? ?[12]\.[01])?", r"sgi-b-[12]\.[01]"),
    ("simpl", r"simple public licen[sc]e( 2\.0)?", r"simpl-2\.0"),
    ("sissl", r"sun industry standards source licen[sc]e( (v|version )?\.? ?1\.[12])?", r"sissl(-1\.2)?"),
    ("sleepycat", r"sleepycat licen[sc]e", r"sleepycat"),
    ("smppl", r"secure messaging protocol public licen[sc]e", r"smppl"),
    ("spl", r"sun public licen[sc]e( (v|version )?\.? ?1\.0)?", r"spl-1\.0"),
    ("sspl", r"server side public licen[sc]e( (v|version )?\.? ?1)?", r"sspl-1\.0"),
    ("sugarcrm", r"sugarcrm public licen[sc]e( (v|version )?\.? ?1\.1\.3)?", r"sugarcrm-1\.1\.3"),
    ("tcl", r"tcl/tk licen[sc]e", r"tcl"),
    ("tmate", r"tmate open source licen[sc]e", r"tmate"),
    ("unicode", r"unicode( inc\.)? licen[sc]e( agreement)?", r"unicode-(dfs-201[56]|tou|3\.0)"),
    ("unlicense", r"(the )?unlicen[sc]e", r"unlicense"),
    ("upl", r"universal permissive licen[sc]e( (v|version )?\.? ?1\.0)?", r"upl-1\.0"),
    ("vim", r"vim licen[sc]e", r"vim"),
    ("vsl", r"vovida software licen[sc]e( (v|version )?\.? ?1\.0)?", r"vsl-1\.0"),
    ("w3c", r"w3c (software|document)( and document)?( notice and)? licen[sc]e", r"w3c(-19980720|-20150513)?"),
    ("watcom", r"sybase open watcom public licen[sc]e( (v|version )?\.? ?1\.0)?", r"watcom-1\.0"),
    ("wtfpl", r"(do what the f[a-z*]* you want to public licen[sc]e|wtfpl)", r"wtfpl"),
    ("xerox", r"xerox licen[sc]e", r"xerox"),
    ("xfree86", r"xfree86 licen[sc]e( (v|version )?\.? ?1\.1)?", r"xfree86-1\.1"),
    ("xpp", r"xpp licen[sc]e", r"xpp"),
    ("ypl", r"yahoo public licen[sc]e( (v|version )?\.? ?1\.[01])?", r"ypl-1\.[01]"),
    ("zed", r"zed licen[sc]e", r"zed"),
    ("zend", r"zend (engine )?licen[sc]e( (v|version )?\.? ?2\.0)?", r"zend-2\.0"),
    ("zimbra", r"zimbra public licen[sc]e( (v|version )?\.? ?1\.[34])?", r"zimbra-1\.[34]"),
    ("zlib", r"zlib( libpng)? licen[sc]e", r"zlib(-acknowledgement)?"),
    ("zpl", r"zope public licen[sc]e( (v|version )?\.? ?[12]\.[01])?", r"zpl-[12]\.[01]"),
]

# what notices and grants say
_NOTICES = [
    ("apache", "licen", r"licensed under the apache licen[sc]e( version)? 2\.0( the license)?( you may not use this file except in compliance with the licen[sc]e)?"),
    ("apache", "licen", r"http[s]?://www\.apache\.org/licenses/license-2\.0(\.txt)?"),
    ("mit", "permission", r"permission is hereby granted free of charge to any person obtaining a copy( of this software( and associated documentation files)?)?"),
    ("isc", "permission", r"permission to use copy modify and(/or)? distribute this software for any purpose with or without fee is hereby granted"),
    ("hpnd", "permission", r"permission to use copy modify( and)? distribute( and sell)? this software and its documentation for any purpose( is hereby granted)? without fee"),
    ("bsd", "redistribut", r"redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd-2", "redistribut", r"redistributions in binary form must reproduce the above copyright notice"),
    ("bsd-3", "permission", r"neither the name of .{1,80} nor the names of its contributors may be used to endorse or promote products .{0,60}without specific prior written permission"),
    ("bsd-3", "redistribut", r"redistribution and use .{0,120}without specific prior written permission"),
    ("bsd-4", "copyright", r"all advertising materials mentioning features or use of this software must display the following acknowledge?ment.{0,80}copyright"),
    ("gpl", "redistribut", r"you can redistribute it and/or modify it under the terms of the gnu general public licen[sc]e"),
    ("lgpl", "redistribut", r"you can redistribute it and/or modify it under the terms of the gnu (lesser|library) general public licen[sc]e"),
    ("agpl", "redistribut", r"you can redistribute it and/or modify it under the terms of the gnu affero general public licen[sc]e"),
    ("gpl", "licen", r"you should have received a copy of the gnu general public licen[sc]e"),
    ("lgpl", "licen", r"you should have received a copy of the gnu (lesser|library) general public licen[sc]e"),
    ("agpl", "licen", r"you should have received a copy of the gnu affero general public licen[sc]e"),
    ("gfdl", "permission", r"permission is granted to copy distribute and/or modify this document under the terms of the gnu free documentation licen[sc]e"),
    ("mpl", "licen", r"this source code form is subject to the terms of the mozilla public licen[sc]e"),
    ("mpl", "licen", r"the contents of this file are subject to the mozilla public licen[sc]e"),
    ("epl", "licen", r"this program and the accompanying materials are made available under the terms of the eclipse public licen[sc]e"),
    ("cddl", "licen", r"the contents of this file are subject to the terms of the common development and distribution licen[sc]e"),
    ("bsl", "licen", r"distributed under the boost software licen[sc]e"),
    ("zlib", "permission", r"permission is granted to anyone to use this software for any purpose including commercial applications"),
    ("zlib", "warrant", r"this software is provided as-is without any express or implied warranty"),
    ("unlicense", "domain", r"this is free and unencumbered software released into the public domain"),
    ("cc0", "domain", r"waived all copyright and related (or|and) neighbo(u)?ring rights.{0,80}public domain"),
    ("cc0", "cc0", r"cc0 1\.0 universal"),
    ("cc0", "domain", r"creativecommons\.org/publicdomain/zero/1\.0"),
    ("cc-by", "commons", r"creativecommons\.org/licenses/by/[1-4]\.[05]"),
    ("cc-by-sa", "commons", r"creativecommons\.org/licenses/by-sa/[1-4]\.[05]"),
    ("cc-by-nc", "commons", r"creativecommons\.org/licenses/by-nc/[1-4]\.[05]"),
    ("cc-by-nd", "commons", r"creativecommons\.org/licenses/by-nd/[1-4]\.[05]"),
    ("cc-by-nc-sa", "commons", r"creativecommons\.org/licenses/by-nc-sa/[1-4]\.[05]"),
    ("cc-by-nc-nd", "commons", r"creativecommons\.org/licenses/by-nc-nd/[1-4]\.[05]"),
    ("creative-commons", "commons", r"(licensed|released|available|shared|published) under (a |the )?creative commons"),
    ("ofl", "licen", r"this font software is licensed under the sil open font licen[sc]e"),
    ("postgresql", "permission", r"permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement"),
    ("openssl", "redistribut", r"this product includes software developed by the openssl project.{0,200}redistribut[a-z]*"),
    ("warranty-disclaimer", "warrant", r"(the|this) (software|program|work|library) is (provided|distributed) (as is|in the hope that it will be useful).{0,40}without (any )?warrant(y|ies)( of any kind)?"),
    ("proprietary", "proprietary", r"(this (software|document|work)|the information contained) .{0,60}(is )?(proprietary( and| or) confidential|confidential and proprietary)"),
    ("proprietary", "permission", r"no part of this (publication|document|work|book) may be reproduced.{0,200}without( the)?( prior)? (written )?permission"),
    ("proprietary", "licen", r"subject to the terms of (the|a|an) (end user|commercial|proprietary) licen[sc]e( agreement)?"),
    ("non-commercial", "may be used for", r"may be used for (non-?commercial|personal|educational|research) (use|purposes) only"),
    ("non-commercial", "permission", r"permission is granted for (non-?commercial|personal|educational|research) (use|purposes) only"),
    ("public-domain", "domain", r"(released|placed|dedicated|released in)( in)?(to)? the public domain"),
    ("reserved", "reserved", r"copyright( c)?( [0-9]{4}(-[0-9]{2,4})?)? .{0,80}all rights reserved"),
]

# mentions, the weakest
_MENTIONS = [
    ("public-domain", "domain", r"public domain"),
    ("creative-commons", "commons", r"creative commons"),
    ("cc-by", "cc-by", r"cc-by([ -][1-4]\.[05])?"),
    ("cc-by", "cc by", r"cc by( [1-4]\.[05])?"),
    ("cc-by-sa", "cc-by", r"cc-by-sa([ -][1-4]\.[05])?"),
    ("cc-by-sa", "cc by", r"cc by[ -]sa( [1-4]\.[05])?"),
    ("cc-by-nc", "cc-by", r"cc-by-nc([ -][1-4]\.[05])?"),
    ("cc-by-nc", "cc by", r"cc by[ -]nc( [1-4]\.[05])?"),
    ("cc-by-nd", "cc-by", r"cc-by-nd([ -][1-4]\.[05])?"),
    ("cc-by-nd", "cc by", r"cc by[ -]nd( [1-4]\.[05])?"),
    ("cc0", "cc0", r"cc0"),
    ("gpl", "gpl", r"(gnu )?gpl( ?-?v?[123](\.0)?)?"),
    ("lgpl", "gpl", r"(gnu )?lgpl( ?-?v?[23](\.[01])?)?"),
    ("agpl", "gpl", r"(gnu )?agpl( ?-?v?[123](\.0)?)?"),
    ("gpl", "licen", r"general public licen[sc]e"),
    ("copyleft", "copyleft", r"copyleft"),
    ("reserved", "reserved", r"all rights reserved"),
    ("reserved", "reserved", r"(some|certain) rights reserved"),
    ("copyright", "copyright", r"copyright( c)?( by)? [0-9]{4}(-[0-9]{2,4})?"),
    ("trademark", "trademark", r"(registered )?trademarks? of"),
    ("open-source", "licen", r"open[ -]source licen[sc]es?"),
    ("proprietary", "licen", r"(commercial|proprietary|end user) licen[sc]e( agreement)?"),
]


def literals(pattern: str) -> list[str]:
    """Texts of which every match holds at least one: the most telling run of plain characters
    that the pattern cannot match without, or one such run for each of its alternatives."""
    return _required(list(_parser.parse(pattern))) or [""]


def _required(items) -> list[str]:
    best: list[str] = []
    run = ""
    for op, arg in [*items, (None, None)]:
        if op is _parser.LITERAL:
            run += chr(arg)
            continue
        best = _better(best, [run] if run.strip() else [])
        run = ""
        if op is _parser.SUBPATTERN:
            best = _better(best, _required(list(arg[-1])))
        elif op is _parser.BRANCH:
            each = [_required(list(x)) for x in arg[1]]
            best = _better(best, [k for ks in each for k in ks] if all(each) else [])
        elif op is _parser.MAX_REPEAT and arg[0] > 0:
            best = _better(best, _required(list(arg[2])))
    return best


def _better(a: list[str], b: list[str]) -> list[str]:
    """The alternative set whose weakest text is longer; texts that nearly all rules share tell little."""
    worth = lambda ks: min((len(k.strip()) if "licen" not in k else 1 for k in ks), default=0)
    return b if worth(b) > worth(a) else a


def _word(pattern: str) -> str:
    return f"(?<![0-9a-z])(?:{pattern})(?![0-9a-z])"


def rules() -> list[tuple[str, int, str, str]]:
    """All rules in order: tags, notices, names, mentions."""
    out = [(label, TAG, "spdx", _word(rf"spdx-license-identifier: ?(?:{tag})")) for label, _, tag in _FAMILIES]
    out += [(label, NOTICE, key, _word(pattern)) for label, key, pattern in _NOTICES]
    keys = {"hpnd": "permission", "wtfpl": "", "cc0": "", "imatix": "imatix", "mulan": "mulan", "nasa": "nasa open source"}
    for label, name, _ in _FAMILIES:
        out.append((label, NAME, keys.get(label, "licen"), _word(name)))
    out += [(label, MENTION, key, _word(pattern)) for label, key, pattern in _MENTIONS]
    return out
