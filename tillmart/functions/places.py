"""Locations, their locales, and name lists.

Locations come from a file, by default ``locations.csv`` beside this module: code,
name, and the upper-case name where it is another than the name in upper case. A
location's id is its line. Ids, codes and names are fixed values.
"""

import csv
from importlib import resources


def read_locations(lines: list[str]) -> list[tuple[int, str, str, str]]:
    """Id, code, name and upper-case name of each line."""
    return [
        (number, row["iso_country_code"], row["country_name"], row["country_code_name"] or row["country_name"].upper())
        for number, row in enumerate(csv.DictReader(lines), 1)
    ]


LOCATIONS = read_locations(resources.files(__package__).joinpath("locations.csv").read_text("utf-8").splitlines())

# Fixed values.
COUNTRY_LOCALES = {
    "Australia": "en_AU", "Austria": "de_AT", "Bahrain": "en_US",
    "Belgium": "fr_BE", "Brazil": "pt_BR", "Canada": "en_CA",
    "Channel Islands": "en_GB", "Cyprus": "el_CY", "Czech Republic": "cs_CZ",
    "Denmark": "da_DK", "EIRE": "en_IE", "European Community": "en_US",
    "Finland": "fi_FI", "France": "fr_FR", "Germany": "de_DE",
    "Greece": "el_GR", "Iceland": "en_US", "Israel": "he_IL",
    "Italy": "it_IT", "Japan": "ja_JP", "Lebanon": "ar_SA",
    "Lithuania": "lt_LT", "Malta": "mt_MT", "Netherlands": "nl_NL",
    "Norway": "no_NO", "Poland": "pl_PL", "Portugal": "pt_PT",
    "RSA": "en_US", "Saudi Arabia": "ar_SA", "Singapore": "en_US",
    "Spain": "es_ES", "Sweden": "sv_SE", "Switzerland": "de_CH",
    "USA": "en_US", "United Arab Emirates": "ar_AE",
    "United Kingdom": "en_GB", "Unspecified": "en_US",
}

DEFAULT_LOCALE = "en_US"

# Names per language: six first and five last ones, so that a pool of thirty has no name twice.
NAMES = {
    "en": (["Alice", "Brian", "Clare", "David", "Emma", "Frank"], ["Archer", "Baker", "Cooper", "Dawson", "Ellis"]),
    "de": (["Anke", "Bernd", "Clara", "Dieter", "Eva", "Frieda"], ["Bauer", "Fischer", "Huber", "Maier", "Weber"]),
    "fr": (["Anne", "Benoit", "Chloe", "Denis", "Elise", "Fabien"], ["Bernard", "Dubois", "Lambert", "Moreau", "Petit"]),
    "es": (["Ana", "Blanca", "Carlos", "Diego", "Elena", "Felipe"], ["Castro", "Diaz", "Garcia", "Lopez", "Ruiz"]),
    "pt": (["Alda", "Bruno", "Carla", "Duarte", "Ines", "Filipe"], ["Almeida", "Costa", "Lima", "Pereira", "Sousa"]),
    "it": (["Anna", "Bruno", "Carla", "Dario", "Elisa", "Fabio"], ["Bianchi", "Conti", "Ferrari", "Greco", "Ricci"]),
    "nl": (["Anouk", "Bram", "Cato", "Daan", "Eline", "Floor"], ["Bakker", "Dekker", "Jansen", "Mulder", "Visser"]),
    "sv": (["Astrid", "Bengt", "Cajsa", "David", "Ebba", "Folke"], ["Berg", "Dahl", "Ekman", "Holm", "Lind"]),
    "pl": (["Adam", "Basia", "Celina", "Dawid", "Ewa", "Filip"], ["Kowal", "Lis", "Nowak", "Sikora", "Zalewski"]),
    "cs": (["Adela", "Bohdan", "Cyril", "Dana", "Emil", "Hana"], ["Benes", "Cerny", "Dvorak", "Horak", "Novak"]),
    "da": (["Asger", "Birgit", "Carsten", "Ditte", "Esben", "Freja"], ["Andersen", "Bach", "Jensen", "Krogh", "Lund"]),
    "el": (["Alexis", "Danai", "Eleni", "Giorgos", "Katerina", "Nikos"], ["Alexiou", "Dimou", "Ioannou", "Laskaris", "Pappas"]),
    "fi": (["Aino", "Eero", "Helmi", "Jukka", "Kaisa", "Lauri"], ["Aalto", "Heino", "Koski", "Laine", "Niemi"]),
    "he": (["Adi", "Boaz", "Dalia", "Eitan", "Galit", "Noam"], ["Amir", "Barak", "Golan", "Levi", "Peretz"]),
    "ja": (["Akira", "Chie", "Daiki", "Emi", "Haruto", "Keiko"], ["Abe", "Fujita", "Ito", "Mori", "Tanaka"]),
    "ar": (["Amal", "Bilal", "Dina", "Fadi", "Hala", "Karim"], ["Aziz", "Darwish", "Haddad", "Khalil", "Nasser"]),
    "lt": (["Aiste", "Benas", "Dalia", "Egle", "Jonas", "Lukas"], ["Balsys", "Kazlauskas", "Petrauskas", "Sabonis", "Urbonas"]),
    "mt": (["Anton", "Carmena", "Dun", "Grezzju", "Katarina", "Pawlu"], ["Borg", "Camilleri", "Farrugia", "Vella", "Zammit"]),
    "no": (["Arne", "Bjarne", "Dagny", "Eivind", "Frida", "Guro"], ["Aas", "Dahl", "Haugen", "Moen", "Solberg"]),
}

#: Locations with a locale of their own, those of the sales feed, in order of id.
FEED_COUNTRIES = [location for location in LOCATIONS if location[2] in COUNTRY_LOCALES]
