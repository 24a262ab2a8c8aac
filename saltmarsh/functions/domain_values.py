"""Fixed values that results depend on: intents, curation rules and false-positive reasons, in their natural order."""

# Search intents (id, all of, any of)
INTENTS = [
    ('lubricant_antioxidant', ('lubricant', 'antioxidant'), ()),
    ('lubricating_oil_antioxidant', ('lubricating oil', 'antioxidant'), ()),
    ('lubricant_oxidation_inhibitor', ('lubricant', 'oxidation inhibitor'), ()),
    ('oil_antioxidant_types', ('antioxidant',), ('engine oil', 'motor oil', 'base oil', 'synthetic oil', 'turbine oil', 'gear oil')),
    ('oil_oxidation_stability', ('oxidation stability',), ('lubricant', 'lubricating oil', 'oil', 'grease')),
    ('oil_oxidative_degradation', ('oxidative degradation',), ('lubricant', 'oil', 'grease')),
    ('oil_thermal_oxidation', ('thermal oxidation',), ('lubricant', 'lubricating oil', 'oil')),
    ('oil_oxidation_mechanism', ('oxidation mechanism',), ('lubricant', 'oil')),
    ('antioxidant_additive', ('antioxidant additive',), ('lubricant', 'oil', 'grease', 'lubrication')),
    ('oxidation_inhibitor_additive', ('oxidation inhibitor',), ('lubricant', 'oil', 'grease')),
    ('hindered_phenol', ('hindered phenol',), ('lubricant', 'oil', 'oxidation', 'antioxidant')),
    ('phenolic_antioxidant', ('phenolic antioxidant',), ('lubricant', 'oil', 'oxidation')),
    ('aminic_antioxidant', ('aminic antioxidant',), ('lubricant', 'oil')),
    ('aromatic_amine_antioxidant', ('aromatic amine',), ('lubricant', 'oil', 'antioxidant', 'oxidation')),
    ('diphenylamine_oil', ('diphenylamine',), ('lubricant', 'oil', 'antioxidant', 'oxidation')),
    ('zddp', ('ZDDP',), ('lubricant', 'oil', 'antioxidant', 'oxidation')),
    ('zinc_dialkyldithiophosphate', ('zinc dialkyldithiophosphate',), ('lubricant', 'oil', 'antioxidant', 'oxidation')),
    ('oxidation_induction_time', ('oxidation induction time',), ('lubricant', 'oil')),
    ('lubricant_degradation', ('lubricant degradation',), ('oxidation', 'antioxidant', 'thermal')),
    ('oil_aging_oxidation', ('oil aging',), ('oxidation', 'antioxidant', 'lubricant')),
    ('grease_oxidation', ('grease', 'oxidation'), ('antioxidant', 'stability', 'degradation')),
    ('radical_scavenger_oil', ('radical scavenger',), ('lubricant', 'oil', 'antioxidant')),
    ('free_radical_oil', ('free radical',), ('lubricant', 'lubricating oil', 'engine oil')),
    ('antioxidant_synergy', ('antioxidant', 'synergy'), ('lubricant', 'oil')),
    ('antioxidant_depletion', ('antioxidant depletion',), ('lubricant', 'oil')),
    ('lubricant_oxidation', ('lubricant', 'oxidation'), ('anti-oxidant', 'stability', 'degradation', 'inhibitor')),
    ('oil_antioxidant_broad', ('oil', 'antioxidant'), ('lubricant', 'lubrication', 'additive')),
]

# Curation rules, first match wins (id, name, scope, subclass, patterns, SMILES, note)
CURATION_RULES = [
    ('AMN001', "4,4'-Dioctyldiphenylamine (DODPA)", 'core_specific', 'alkylated diarylamine', ('^dodpa$', 'dioctyl.*diphenylamine', 'di-?iso-?octyl-?diphenylamine'), 'CCCCCCCCc1ccc(Nc2ccc(CCCCCCCC)cc2)cc1', ''),
    ('AMN002', "4,4'-Di-tert-butyldiphenylamine (tBu2DPA)", 'core_specific', 'alkylated diarylamine', ('^tbu2dpa$', 'di-?tert-?butyl.*diphenylamine'), 'CC(C)(C)c1ccc(Nc2ccc(C(C)(C)C)cc2)cc1', ''),
    ('AMN003', '4-Isooctyldiphenylamine', 'core_specific', 'alkylated diarylamine', ('^p-?isooctyldiphenylamine$',), '', 'Reported isooctyl substituent is not a unique constitutional structure.'),
    ('AMN004', 'Diphenylamine', 'core_specific', 'diarylamine', ('^diphenylamine(?: \\(dpa\\))?$', '^dpa$', '^ph2nh \\(diphenylamine\\)$', '^diphenytamine$', '^dpa antioxidant$', '^dpa \\(aromatic amine derivative\\)$'), 'c1ccc(Nc2ccccc2)cc1', ''),
    ('AMN005', 'N-(4-Octylphenyl)-1-naphthylamine (octyl PANA)', 'core_specific', 'arylnaphthylamine', ('octyl.*phenyl.*(?:alpha|a)-?naphthylamine', 'p-octyl-n-phenyl-a-naphthylamine'), '', 'The literature label does not specify the octyl branching pattern.'),
    ('AMN006', 'N-Phenyl-1-naphthylamine (PANA)', 'core_specific', 'arylnaphthylamine', ('^(?:n-)?phenyl-?(?:1|alpha|a|l)[ -]?(?:naphthylamine|naphtylamine)(?: \\([^)]*\\))?$', '^phenyl ?alpha ?naphthylamine$', '^phenyl-alpha-napthylamine$', '^phenyl-~-naphthyl-amine$', '^phenyl-r-naphthylamine \\(pan\\)$', '^-naphthyl-phenyl-amine \\(npa\\)$', '^n-phenylnaphth-1-ylamine$', '^n-alpha-naphthyl-n-phenylamine$', '^pana(?: \\(aromatic amine derivative\\))?$', '^pan$', '^a-npa$', '^n-phenyl-naphthylamine$'), 'c1ccc(Nc2cccc3ccccc23)cc1', ''),
    ('AMN007', 'N-Phenyl-2-naphthylamine (PBNA/Neozone D)', 'core_specific', 'arylnaphthylamine', ('^(?:n-)?phenyl-?(?:2|3|7|beta|b|fl)[ -]?(?:naphthylamine|naphthyl-amine)', '^beta-naphthylphenylamine$'), 'c1ccc(Nc2ccc3ccccc3c2)cc1', 'OCR labels 3, 7, B, fl, and /3 were consolidated with the beta/2-naphthyl isomer.'),
    ('AMN008', "N,N'-Diphenyl-p-phenylenediamine (DPPD)", 'core_specific', 'p-phenylenediamine', ('^dppd$', 'di-?phenyl.*p-?phenyl(?:ene|en|£-phenylene).*diamine', 'di-?phenyl-1,4-phenylenediamine'), 'c1ccc(Nc2ccc(Nc3ccccc3)cc2)cc1', ''),
    ('AMN009', 'N-Phenyl-p-phenylenediamine (NPPD)', 'core_specific', 'p-phenylenediamine', ('^nppd$', '^n-ppda$', 'n-phenyl-(?:1, ?4-|p-)?phenylenediam', 'n-phenyl-p-phenylenediammine'), 'Nc1ccc(Nc2ccccc2)cc1', ''),
    ('AMN010', "N,N'-Di-sec-butyl-p-phenylenediamine (DBPDA)", 'core_specific', 'p-phenylenediamine', ('di-sec-butyl-p-phenylenediamine', 'dibutan-2-ylbenzene-1,4-diamine'), 'CCC(C)Nc1ccc(NC(C)CC)cc1', ''),
    ('AMN011', "N-Isopropyl-N'-phenyl-p-phenylenediamine (IPPD)", 'core_specific', 'p-phenylenediamine', ("n-phenyl-n'-isopropyl-p-phenylenediamine", "n-isopropyl-n'-phenyl-p-phenylenediamine", '^ippd$'), 'CC(C)Nc1ccc(Nc2ccccc2)cc1', ''),
    ('AMN012', "N-Cyclohexyl-N'-phenyl-p-phenylenediamine (CPPD/Flexzone 6H)", 'core_specific', 'p-phenylenediamine', ('^flexzone 6h$', "n-phenyl-n'-cyclohexyl-p-phenylenediamine", "n-cyclohexyl-n'-phenyl"), 'c1ccc(Nc2ccc(NC3CCCCC3)cc2)cc1', ''),
    ('AMN013', 'p-Phenylenediamine', 'core_specific', 'p-phenylenediamine', ('^p-?phenylene-?diamine$', '^p-phenylenediamine$'), 'Nc1ccc(N)cc1', ''),
    ('AMN014', 'm-Phenylenediamine', 'core_specific', 'phenylenediamine', ('^meta-phenylene-?diamine$',), 'Nc1cccc(N)c1', ''),
    ('AMN015', "N,N,N',N'-Tetramethyl-p-phenylenediamine", 'core_specific', 'tertiary aromatic diamine', ('tetra-?methyl.*p-?phenylenediamine', '^tetramethyl-p-phenylenediamine$', "^v,ar'-tetra-methyl-/>-phenylenediamine$"), 'CN(C)c1ccc(N(C)C)cc1', 'No N-H bond; retained because the source explicitly evaluates it as an amine antioxidant.'),
    ('AMN016', 'Phenothiazine', 'core_specific', 'heterocyclic diarylamine', ('^ptz$', '^phenothiazine(?: \\(98 %\\)| 9)?$'), 'c1ccc2Sc3ccccc3Nc2c1', ''),
    ('AMN017', '3,7-Dimethoxyphenothiazine', 'core_specific', 'heterocyclic diarylamine', ('^3,7-dimethoxyphenothiazine$',), 'COc1ccc2Sc3ccc(OC)cc3Nc2c1', ''),
    ('AMN018', 'Phenoxazine', 'core_specific', 'heterocyclic diarylamine', ('^phenoxazine(?: 10)?$',), 'c1ccc2Oc3ccccc3Nc2c1', ''),
    ('AMN019', 'Ethoxyquin', 'core_specific', 'dihydroquinoline', ('^ethoxyquin(?: \\(i\\))?$', '^emq$', '^6-ethoxy-2,2,4-trimethyl-1,2-dihydroquinoline$'), 'CCOc1ccc2c(c1)C(C)=CC(C)(C)N2', ''),
    ('AMN020', '5-Ethyl-10,10-diphenylphenazasiline', 'core_specific', 'heterocyclic arylamine', ('^5-ethyl-10,10-diphenylphenazasiline',), '', 'Specific reported molecule; structure was not recoverable from the extraction.'),
    ('AMN021', "4,4'-Bis(dimethylamino)diphenylamine", 'core_specific', 'tertiary/secondary aromatic amine', ("^4,4'-bis\\(n,n-dimethylamino\\)diphenylamine$",), 'CN(C)c1ccc(Nc2ccc(N(C)C)cc2)cc1', ''),
    ('AMN023', 'Dimethyl-bis(p-phenylaminophenoxy)silane', 'core_specific', 'silicon-containing diarylamine', ('^dimethyl-bis\\(p-phenylaminophenoxy\\)silane',), '', 'Specific reported molecule; source structure check required.'),
    ('AMF001', 'Alkylated diphenylamines (ADPA)', 'core_family', 'alkylated diarylamine mixture/family', ('^adpas?$', '^adpa(?: \\(alkylated diphenylamine\\))?$', 'alkylated diphenyl ?amines?', '^alkyldiphenylamine$', '^mixed alkylated diphenyl amine$', '^alkylated diphenylamine antioxidants$', '^diphenylamines$', '^odpa$'), '', 'ADPA is a compositional family/mixture, not one molecule.'),
    ('AMF002', 'Nonylated diphenylamine (NDPA)', 'core_family', 'alkylated diarylamine mixture/family', ('^ndpa$', 'nonylated diphenylamine', 'diisononyldiphenylamine'), '', 'Commercial NDPA is an isomer/substitution mixture.'),
    ('AMF003', 'Styrenated diphenylamine', 'core_family', 'alkylated diarylamine mixture/family', ('^styrenated diphenylamine$',), '', 'Commercial styrenated DPA is a reaction-product mixture.'),
    ('AMF004', 'Octylated/butylated diphenylamine (OBPA)', 'core_family', 'alkylated diarylamine mixture/family', ('octylated.*butylated diphenyl',), '', 'Commercial alkylation mixture.'),
    ('AMF005', 'Dialkylated diphenylamine', 'core_family', 'alkylated diarylamine mixture/family', ('^dialkylated diphenylamine$', '^dialkyldiphenylamine; l-01$'), '', 'Alkyl groups and substitution pattern are not uniquely specified.'),
    ('AMF006', 'Octadecyl diphenylamine (ODA label)', 'core_family', 'alkylated diarylamine', ('^oda \\(octadecyl diphenylamine\\)$',), '', 'Position/branching are not specified; ODA is also ambiguously used for octadecylamine.'),
    ('AMF007', 'Alkoxy/alkylamino diphenylamines', 'core_family', 'substituted diarylamine family', ('^adpa \\(n-sec-alkoxydiphenylamine\\)$', '^alkylaminodiphenylamine'), '', 'Family-level literature label.'),
    ('AMF008', 'Substituted or mixed phenyl-naphthylamines (including APANA/OPANA)', 'core_family', 'arylnaphthylamine mixture/family', ('alkylated-?phenyl-alpha-naphthylamine', '^phenyl-(?:alpha|a)-naphthylamines(?: \\(a\\))?$', '^n-phenyl-alpha,beta-naphthylamine$', '^opana$', '^\\[opana\\]'), '', 'Alkyl substitution and composition are not uniquely specified.'),
    ('AMF009', 'Poly(diphenylamine) derivatives (PDPA)', 'core_family', 'polymeric aromatic amine', ('poly\\(diphenylamine\\)', '^pdpa$'), '', 'Polymeric/reaction-product family; no unique molecular SMILES.'),
    ('AMF010', 'Poly(p-phenylenediamine) (PPDA)', 'core_family', 'polymeric aromatic diamine', ('^poly\\(p-phenylenediamine\\) \\(ppda\\)$',), '', 'Polymer, not a single molecular structure.'),
    ('AMF011', 'Schiff-base/phenolic diphenylamine antioxidants (SPD/SSPD)', 'core_family', 'hybrid aromatic amine family', ('schiff base bridged phenolic diphenylamine', '^sspd', '^rsspd$', 'diphenylamine-phenol antioxidants'), '', 'Multiple related structures/products are grouped because the extraction does not recover the defining figures.'),
    ('AMF012', 'Pyridine-/pyrimidine-containing diarylamines', 'core_family', 'heteroarylamine family', ('pyridine- and pyrimidine-containing diarylamine antioxidants', 'nitrogen-incorporated phenoxazines'), '', 'Family-level label.'),
    ('AMF013', 'Generic phenylenediamine antioxidants', 'core_family', 'aromatic diamine family', ('^p-?phenylenediamines$', '^phenylenediamines$', '^/-phenylenediamine$', '^ppda$', "substituted n,n'-diphenyl-p-phenylenediamine"), '', 'Family-level label; PPDA can also denote the polymer.'),
    ('AMF014', 'Generic phenothiazines', 'core_family', 'heterocyclic diarylamine family', ('^phenothiazines$',), '', 'Plural class mention; not forced to the parent phenothiazine molecule.'),
    ('AMF015', 'Generic diarylamine/arylamine products', 'core_family', 'aromatic amine family/product', ('^arylamine$', '^n-alkyl aniline$', '^[a-z]-[a-z]-[a-z]-methylaniline$', '^a-methylaniline$', '^additin rc 7132$', '^t531$', '^tz516$', '^ao3 \\(amine-type antioxidant\\)$', '^amine one$', '^amine two$', '^nda$', '^noa$', '^sac$', '^am \\(amine antioxidant\\)$'), '', 'Credible aminic label, but no unique identity was recoverable.'),
    ('AMF016', 'Diphenylamine/N-aryl-naphthylamine oligomer reaction products', 'core_family', 'oligomeric aromatic amine', ('^reaction product of specific molar ratios of diphenylamines and n-aryl naphthylamines$',), '', 'Reaction-product mixture.'),
    ('AMA001', 'N,N-Diethylhydroxylamine (DEHA)', 'adjacent_specific', 'hydroxylamine', ('diethylhydroxylamine \\(deha\\)',), 'CCN(O)CC', ''),
    ('AMA002', 'Ethoxyquin nitroxide V', 'adjacent_specific', 'nitroxide transformation product', ('^nitroxide v', '^nitroxide free-radical scavenger$'), '', 'Nitroxide product/scavenger, not an N-H aminic antioxidant.'),
    ('AMA003', 'p-Hydroxydiphenylamine', 'adjacent_specific', 'aminophenol/diarylamine hybrid', ('^p-hydroxydiphenylamine$',), 'Oc1ccc(Nc2ccccc2)cc1', ''),
    ('AMA004', 'p-Aminophenol', 'adjacent_specific', 'aminophenol hybrid', ('^p-aminophenol(?: \\(x\\))?$',), 'Nc1ccc(O)cc1', ''),
    ('AMA005', 'o-Aminophenol', 'adjacent_specific', 'aminophenol hybrid', ('^o-aminophenol$',), 'Nc1ccccc1O', ''),
    ('AMA006', 'm-Aminophenol', 'adjacent_specific', 'aminophenol hybrid', ('^m-aminophenol$',), 'Nc1cccc(O)c1', ''),
    ('AMA007', 'Aniline', 'adjacent_specific', 'simple aromatic amine', ('^aniline(?: \\(anil\\))?$', '^aromatic amines с6н5nh2$'), 'Nc1ccccc1', ''),
    ('AMA008', 'p-Anisidine', 'adjacent_specific', 'simple aromatic amine', ('^p-anisidine \\(anis\\)$',), 'COc1ccc(N)cc1', ''),
    ('AMA009', 'N,N-Dimethylaniline', 'adjacent_specific', 'tertiary aromatic amine', ('^n,n-dimethylaniline$',), 'CN(C)c1ccccc1', ''),
    ('AMA010', 'Diphenylguanidine (DPG)', 'adjacent_specific', 'guanidine antioxidant', ('^diphenylguanidine$', 'diphenylguanidine \\(dpg\\)'), 'NC(=Nc1ccccc1)Nc1ccccc1', ''),
    ('AMA011', 'Ethylenediamine', 'adjacent_specific', 'simple aliphatic diamine', ('^ethylenediamine(?: \\(eda\\))?$',), 'NCCN', ''),
    ('AMA012', "N,N'-Bis(2-hydroxybenzyl)-o-phenylenediamine", 'adjacent_specific', 'aminophenol/diamine hybrid', ('^n,n- bis\\(2-hydroxybenzyl\\)-o-phenylenediamine',), '', 'Reported molecule; stereochemical/positional source check required.'),
    ('AMA013', 'N,N-Bis(2-hydroxy-3,5-di-tert-butylphenyl)-o-ethylenediamine', 'adjacent_specific', 'aminophenol/diamine hybrid', ('^n,n-bis\\(2-hydroxy-3,5-di-tert-butylphenyl\\)-o-ethylenediamine$',), '', 'Reported molecule; source structure check required.'),
    ('AMA014', 'N,N-Bis(4-hydroxy-3-methoxybenzyl)-o-phenylenediamine', 'adjacent_specific', 'aminophenol/diamine hybrid', ('^n,n-bis\\(4-hydroxy-3-methoxybenzyl\\)-o-phenylenediamine$',), '', 'Reported molecule; source structure check required.'),
    ('AMA015', '5-Ethyl-10,10-diphenylphenazasiline', 'adjacent_specific', 'silicon-containing heterocycle', ('^5-ethyl-10,10-diphenylphenazasiline',), '', 'Reported radical inhibitor; source structure check required.'),
    ('AMA016', 'Tinuvin 770', 'adjacent_specific', 'hindered amine light stabilizer (HALS)', ('^tinuvin 770$',), 'CC1(CC(CC(N1)(C)C)OC(=O)CCCCCCCCC(=O)OC2CC(NC(C2)(C)C)(C)C)C', 'HALS/photooxidation stabilizer; source says it has virtually no thermal antioxidant activity in the tested saturated polymer.'),
    ('AMA020', 'alpha-Naphthylamine', 'adjacent_specific', 'primary aromatic amine', ('^a-naphthylamine$',), 'Nc1cccc2ccccc12', ''),
    ('AMA021', 'Dibenzylamine', 'adjacent_specific', 'secondary aliphatic amine', ('^dibenzylamine$',), 'c1ccc(CNCC2=CC=CC=C2)cc1', ''),
    ('AMA022', 'N-Oxydiphenylamine', 'adjacent_specific', 'N-oxy diarylamine', ('^n-oxydiphenylamine$',), '', 'Historical name is structurally ambiguous; source structure must be checked.'),
    ('AMA023', '4-(Dimethylaminomethyl)-2,6-di-tert-butylphenol', 'adjacent_specific', 'aminomethyl phenol hybrid', ('^4-\\(dimethylaminomethyl\\)-2,6-di-tert-butylphenol$',), 'CN(C)Cc1cc(C(C)(C)C)c(O)c(C(C)(C)C)c1', ''),
    ('AMA024', 'Aminomethyl-2-methoxyphenol derivatives', 'adjacent_family', 'aminophenol hybrid family', ('^4,6-di\\[\\(morpholin-4-yl\\)methyl\\]-2-methoxyphenol', 'pyrrolidin-1-yl.*vanillic acid', '^aminomethyl derivative v$'), '', 'Multiple aminomethyl phenol structures; retained as an adjacent family.'),
    ('AMA025', 'beta-Naphthylamine', 'adjacent_specific', 'primary aromatic amine', ('^/3-naphthylamine$',), 'Nc1ccc2ccccc2c1', ''),
    ('AMA017', 'Toluidine (isomer unspecified)', 'adjacent_family', 'simple aromatic amine', ('^toluidine$',), '', 'The ortho/meta/para isomer is not specified.'),
    ('AMA018', 'Aminophenols (generic)', 'adjacent_family', 'aminophenol hybrid family', ('^aminophenol$',), '', 'Isomer/substitution not specified.'),
    ('AMA019', 'Generic aromatic/aminic antioxidants', 'generic_class', 'generic class', ('^aminic antioxidants?$', '^a minic antioxidant$', '^aminic anti-oxidant(?: additives?)?$', '^amine antioxidants?$', '^amine-type antioxidant$', '^amine-based antioxidant$', '^aromatic amines?$', '^aromatic amine antioxidants?$', '^classic amine antioxidants$', '^amines?$', '^amine$', '^secondary amines$', '^mixed amines$', '^aminic$', '^aminic antioxidant system$', '^phenolic/aminic antioxidant system$', '^phenolic/aminic antioxidants$', '^mixed phenol/amine antioxidant system$'), '', 'Class-only mention; cannot be converted into a molecular record.'),
]

# Reasons for exclusion, first match wins (pattern, reason)
EXCLUSION_REASONS = [
    ('tocopher|tocotrien|vitamin e', 'phenolic/tocopherol antioxidant, not aminic'),
    ('ascorb|vitamin c', 'ascorbate antioxidant, not aminic'),
    ('\\bzdd?p\\b|zndt?p|dialkyl.?dithiophosph', 'organometallic/phosphorodithioate additive, not aminic'),
    ('\\bbht\\b|\\bbha\\b|butylated hydro|tbhq|propyl gallate|phenolic antioxidant', 'phenolic antioxidant, not aminic'),
    ('mos2|molybdenum|graphene|graphite|nanoparticle|copper|zinc borate|\\bcuo\\b', 'inorganic/nanomaterial or metal additive, not aminic'),
    ('sitosterol|sesamol|carnos|curcumin|flavon|extract|lignin|rosmarin|tocoph', 'natural/phenolic antioxidant, not aminic'),
    ('octadecylamine|oleylamine|dodecyl amine|alkylamine salts', 'simple long-chain amine used here for surface/tribological function, not supported as an aminic antioxidant'),
    ('phosphatidyl|lecithin|phospholipid', 'phospholipid, not a conventional aminic antioxidant'),
]
