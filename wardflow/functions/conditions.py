"""Condition-flag patterns for diagnosis codes."""

from __future__ import annotations

# Patterns of the 40 comorbidity flags (ICD-10 with dots, then ICD-9): flag, kind, patterns.
COMORBIDITY = """
chf prefix I50 428.
chf exact I09.81 398.91
aids prefix 042 043 044
aids exact B20
alcohol prefix F10 291. 303. 305.0
anemdef prefix D50 D51 D52 D53 D63 D64 280 281 285.2 285.9
arth prefix M05 M06 M08 M12 M32 M33 M34 M35 M45 M46 L40
bldloss prefix O99.01 648.2
bldloss exact D50.0 O90.81 O99.02 O99.03 280.0
chrnlung prefix J40 J41 J42 J43 J44 J45 J47 J60 J61 J62 J63 J64 J66 J67 490 491 492 493. 494 495. 496 497 498 499 500
chrnlung prefix 501 502 503 504 505
chrnlung exact J68.4 506.4
coag prefix D65 D66 D67 D68 D69 286. 287.
coag exact 289.84
depress prefix F32 F33
depress exact F34.1 F43.21 300.4 301.12 309.0 309.1 311
dm prefix E08 E09 E10 E11 E13 249. 250.
dmcx prefix E08.21 E08.22 E08.29 E08.31 E08.32 E08.33 E08.34 E08.35 E08.36 E08.37 E08.39 E08.4 E08.5 E08.6 E08.8
dmcx prefix E09.21 E09.22 E09.29 E09.31 E09.32 E09.33 E09.34 E09.35 E09.36 E09.37 E09.39 E09.4 E09.5 E09.6 E09.8
dmcx prefix E10.21 E10.22 E10.29 E10.31 E10.32 E10.33 E10.34 E10.35 E10.36 E10.37 E10.39 E10.4 E10.5 E10.6 E10.8
dmcx prefix E11.21 E11.22 E11.29 E11.31 E11.32 E11.33 E11.34 E11.35 E11.36 E11.37 E11.39 E11.4 E11.5 E11.6 E11.8
dmcx prefix E13.21 E13.22 E13.29 E13.31 E13.32 E13.33 E13.34 E13.35 E13.36 E13.37 E13.39 E13.4 E13.5 E13.6 E13.8
drug prefix F11 F12 F13 F14 F15 F16 F18 F19 292. 304. 305.2 305.3 305.4 305.5 305.6 305.7 305.8 305.9
hhrwchf exact I13.0 404.01 404.11 404.91
hhrwhrf exact I13.2 404.03 404.13 404.93
hhrwohrf exact I13.10 404.00 404.10 404.90
hhrwrf exact I13.11 404.02 404.12 404.92
hrenworf prefix 642.1
hrenworf exact I12.9 I15.0 I15.1 403.00 403.10 403.90 405.01 405.11 405.91
hrenwrf exact I12.0 403.01 403.11 403.91
htn prefix 401.1 401.9 642.0
htn exact I10
htncx exact I16.0 I16.1 I16.9 I67.4 401.0 437.2
htnpreg prefix O10.111 O10.112 O10.113 O10.119 O10.12 O10.13 O10.211 O10.212 O10.213 O10.219 O10.22 O10.23 O10.311
htnpreg prefix O10.312 O10.313 O10.319 O10.32 O10.33 O10.411 O10.412 O10.413 O10.419 O10.42 O10.43 O11.1 O11.2 O11.3
htnpreg prefix O11.4 O11.5 O11.9
htnwchf exact I11.0 402.01 402.11 402.91
htnwochf exact I11.9 I15.2 I15.8 I15.9 402.00 402.10 402.90 405.09 405.19 405.99
hypothy prefix 243 244
hypothy exact E00.0 E00.1 E00.2 E00.9 E01.8 E02 E03.0 E03.1 E03.2 E03.3 E03.8 E03.9 E89.0
liver prefix B18.0 B18.1 B18.2 I85.0 I85.1 K70. K72. K73. K74. K76. 456. 571.
liver exact K75.4 K75.81 Z94.4 070.22 070.23 070.32 070.33 070.44 070.54 572.3 572.8
lymph prefix C81 C82 C83 C84 C85 C86 C88 C90 C96
lytes prefix 276.
lytes exact E86.0 E86.1 E86.9 E87.0 E87.1 E87.2 E87.3 E87.4 E87.5 E87.6 E87.70 E87.71 E87.79 E87.8
mets prefix C77. C78. C79. C80. C7B. 196. 197 198 199 209.7
mets exact 789.51
neuro prefix E75. G11. G12. G13. G24. G25. G30. G31. G36. G37. G40. G91. G93. O99.350 O99.351 O99.352 O99.353 O99.354
neuro prefix O99.355
neuro exact F84.2 G10 G20 G21.4 G32.81 G35 G47.411 G47.419 G47.421 G47.429 G80.3 G89.0 G94
obese prefix E66. O99.21 Z68.3 Z68.4
obese exact R93.9 Z68.54
ohtnpreg prefix O16. 642.7 642.9
para prefix G80. G81. G82. G83. I69.
para exact G04.1 R53.2
perivasc prefix I70. I71. I72. I73. I74. I77. I79. K55.
perivasc exact I76 Z95.820 Z95.828
psych prefix F20 F22 F23 F24 F25 F28 F29 F30 F31 F33.40 F33.41 F33.42 F34.8
psych exact F32.4 F32.5 F39 F44.89 F84.3
pulmcirc prefix I26. I27. 415.1 416.
pulmcirc exact I28.9 T80.0XXA T82.817A T82.818A 417.9
renlfail prefix N18.3 N18.4 N18.5 N18.6 N18.9 Z49. 585.3 585.4 585.5 585.6 585.9 V56
renlfail exact N19 Z91.15 Z94.0 Z99.2 586 V42.0 V45.1
tumor prefix C00. C01 C02. C03. C04. C05. C06. C08. C09. C10. C11. C13. C14. C15. C16. C17. C18. C21. C22. C24. C25.
tumor prefix C26. C30. C31. C32. C34. C38. C39. C40. C41. C43. C45. C47. C48. C49. C4A. C50. C51. C53. C54. C56. C57.
tumor prefix C60. C62. C63. C64. C65. C66. C67. C68. C69. C70. C71. C72. C74. C75. C76. C7A. C7B. D03.
tumor exact C07 C12 C19 C20 C23 C33 C37 C52 C55 C58 C61 C73
ulcer prefix K25. K26. K27. K28. 531. 532. 533. 534.
valve prefix I05. I06. I07. I08. I34. I35. I36. I37. Q23.
valve exact A52.03 I09.1 I09.89 I38 I39 Z95.2 Z95.3 Z95.4
wghtloss prefix E40 E41 E42 E43 E44.
wghtloss exact E45 E46 E64.0 R63.4 R63.6
"""

# Patterns of the 6 patient flags (codes as the source writes them, partly without a dot).
PATIENT = """
osa_flag exact G4733
cad_mi_flag prefix I21 I22 I25
arrhythmia_flag prefix I47 I48 I49
anxiety_flag prefix F41
dementia_flag prefix F03 G30
functional_disability_flag prefix G81 G82 Z74
functional_disability_flag exact R532
"""
OSA_TEXT = "%sleep apnea%"          # text that also sets osa_flag


def flags(*tables: str) -> list[str]:
    """Names of the flags in the order of the tables."""
    return list(dict.fromkeys(line.split()[0] for table in tables for line in table.split("\n") if line))


def pattern_rows(*tables: str, code_format: str = "as_written") -> list[tuple[str, str, str]]:
    """(flag, kind, pattern) rows; ``code_format='undotted'`` drops the dots for undotted code data."""
    lines = [line.split() for table in tables for line in table.split("\n") if line]
    rows = [(flag, kind, text) for flag, kind, *texts in lines for text in texts]
    if code_format == "undotted":
        return [(f, k, t.replace(".", "")) for f, k, t in rows]
    if code_format == "dotted":
        return [(f, k, t if "." in t or len(t) <= 3 else f"{t[:3]}.{t[3:]}") for f, k, t in rows]
    return rows
