"""Word lists of the review analysis."""

from __future__ import annotations

# Theme identifiers in canonical order, with the vocabulary of each.
THEMES = {
    "securite": (
        "sécurité", "insécurité", "vol", "cambriolage", "agression", "agresser",
        "drogue", "dealer", "délinquance", "délinquant", "police", "incivilité",
        "violence", "racaille", "trafic",
    ),
    "calme": (
        "calme", "tranquille", "tranquillité", "paisible", "reposant", "serein",
        "bruit", "bruyant", "nuisance sonore", "tapage", "tapage nocturne",
        "vacarme", "silencieux",
    ),
    "transports": (
        "transport", "métro", "tramway", "tram", "bus", "rer", "gare", "train",
        "stationnement", "parking", "se garer", "piste cyclable", "vélo",
        "embouteillage", "circulation", "desservi", "desserte", "autoroute",
    ),
    "commerces": (
        "commerce", "magasin", "boutique", "marché", "supermarché", "restaurant",
        "bar", "boulangerie", "cafe", "café", "commerçant", "commercial",
    ),
    "education": (
        "école", "collège", "lycée", "université", "crèche", "enseignement",
        "scolaire", "éducation", "établissement scolaire",
    ),
    "environnement": (
        "propreté", "propre", "sale", "saleté", "pollution", "pollué", "déchet",
        "poubelle", "espace vert", "parc", "jardin", "nature", "verdure", "arbre",
    ),
}

# Words too generic for a word cloud.
GENERIC_WORDS = (
    "grand", "petit", "bon", "mauvais", "premier", "deuxième", "troisième",
    "certain", "même", "autre", "quelque", "seul", "tel", "tout", "aucun",
    "nombreux", "différent", "nouveau", "vieux", "dernier", "prochain",
    "long", "court", "haut", "bas", "plein", "vrai", "faux", "possible",
    "difficile", "facile", "important", "général", "principal", "simple",
    "normal", "naturel", "national", "international", "public", "privé",
    "parisien", "lyonnais", "marseillais", "bordelais", "lillois",
    "chose", "endroit", "coin", "fois", "année", "gens", "personne", "point",
    "ville", "rue", "côté", "jour", "temps", "monde", "vie", "lieu", "part",
    "niveau", "moment", "cas", "type", "manière", "façon", "nombre", "ensemble",
)

# French function words, which never make a token.
STOP_WORDS = (
    "alors", "après", "assez", "aussi", "autres", "avant", "avec", "avoir", "beaucoup",
    "car", "ces", "cet", "cette", "ceux", "chez", "comme", "dans", "des", "donc", "dont",
    "elle", "elles", "encore", "entre", "est", "et", "été", "être", "eux", "fait", "font",
    "ici", "ils", "leur", "leurs", "les", "mais", "mes", "moins", "mon", "nos", "notre",
    "nous", "ont", "par", "pas", "peu", "peut", "plus", "pour", "pourtant", "puis", "que",
    "quel", "quelle", "qui", "quoi", "sans", "ses", "son", "sont", "sous", "souvent", "sur",
    "tous", "toute", "toutes", "très", "trop", "une", "vers", "vos", "votre", "vous", "était",
)
