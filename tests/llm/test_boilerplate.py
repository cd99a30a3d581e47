"""Boilerplate lines in each language, and lines that only look like them."""

from __future__ import annotations

import pytest

from oreline.llm import line_rules

PROSE = " ".join(f"word{k}" for k in range(40)) + "."


@pytest.mark.parametrize(
    "line",
    [
        "Copyright 2020 Acme, ALL RIGHTS RESERVED.",
        "© Beispiel GmbH. Alle Rechte vorbehalten.",
        "Bitte lesen Sie unsere DATENSCHUTZERKLÄRUNG genau.",
        "Exemple SA. Tous droits réservés.",
        "Voir nos conditions d’utilisation du site.",
        "Voir nos CONDITIONS D'UTILISATION du site.",
        "Ejemplo. Todos los derechos reservados.",
        "Consulte la POLÍTICA DE PRIVACIDAD del sitio.",
    ],
)
def test_lines_of_every_language_fail(spark, line):
    rows = spark.createDataFrame([(f"{PROSE}\n{line}\n{PROSE}",)], "text string")
    (row,) = line_rules.clean(rows).collect()
    assert (row.n_lines_removed, row.clean_text) == (1, f"{PROSE}\n{PROSE}")


@pytest.mark.parametrize(
    "line",
    [
        "Er blickte lange nach oben und schwieg.",
        "Elle a toujours aimé la politique de son pays.",
        f"{PROSE} Nutzungsbedingungen gelten auch in langen Zeilen.",
    ],
)
def test_prose_stays(spark, line):
    rows = spark.createDataFrame([(f"{PROSE}\n{line}",)], "text string")
    (row,) = line_rules.clean(rows).collect()
    assert (row.n_lines_removed, row.clean_text) == (0, f"{PROSE}\n{line}")
