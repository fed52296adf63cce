"""The set of license notices, the best template of a span, and the words that decide between short notices."""

import pytest

from delaykit.llm.licenses import TEMPLATES, LicenseIndex, scan

INDEX = LicenseIndex(TEMPLATES)


def found(text):
    return [h[0] for h in scan(f"Some words here. {text} And more words there.", INDEX)]


@pytest.mark.parametrize("name", sorted(TEMPLATES))
def test_a_notice_is_found_alone(name):
    assert found(TEMPLATES[name]) == [name]


@pytest.mark.parametrize("text, names", [
    ("All rights reserved.", ["All-rights-reserved"]),
    ("Licensed under CC BY 4.0.", ["CC-BY-4.0-notice"]),
    ("Licensed under CC BY-SA 4.0.", ["CC-BY-SA-4.0-notice"]),
    ("Licensed under CC BY-NC 2.5.", []),
    ("This work is licensed under the GNU Lesser General Public License, version 3.", ["LGPL-3.0"]),
    ("This work is licensed under the GNU General Public License, version 4.", []),
    ("SPDX-License-Identifier: GPL-3.0-or-later", ["GPL-3.0-or-later-spdx"]),
    ("Released under the MIT License. All rights reserved.", ["MIT", "All-rights-reserved"]),
])
def test_deciding_words(text, names):
    assert found(text) == names
