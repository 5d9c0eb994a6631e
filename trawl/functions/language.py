"""Language weights of a text by character trigrams (X31, G14), one Arrow pass over whole texts.

A language's profile counts the trigrams of its most frequent words and of the first
articles of the Universal Declaration of Human Rights.  A text is scored piece by piece,
a piece together with its neighbours; a language's weight is its share of the pieces.
A piece whose trigrams no profile knows has no language, and a language of under a
tenth of a text is noise.
"""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

WORDS = {
    "en": "the and this is are was were of to in that it with for as his her they be at have from or had by but not what all when we there can an your which their said if do will each about how up out them then she many some so these would other into has more two him see could no make than been who its now only over also after first new because any work people years well even where most through between before under such way here those",
    "fr": "le la les des du et est un une ceci ce cette ces que qui dans pour pas sur avec plus par au aux il elle nous vous ils sont mais ou où être avoir fait ses son sa leur dont cela cet été comme tout bien sans aussi même deux faire peut très encore entre après depuis sous lui on ne se si tous était avait autres leurs toujours notre votre quand alors",
    "es": "el los las del y es una uno esto este esta por que en con para como pero más mas sus al lo se su ya muy sin sobre también entre cuando todo nos durante son hay ser fue era han desde hasta donde porque dos así cada vez puede años otro otra ellos nosotros ese eso hace tiene parte después siempre bien mismo según están",
    "de": "der die das und ist ein eine einer einem einen nicht auch sich mit von den dem des im für auf aus zu zur zum bei nach wie über aber oder sind wird werden war hat durch wenn nur noch so es sie er wir ich kann haben als dass vor sehr mehr schon unter am bis gegen alle seine ihre diese dieser dieses man können sein wurde zwischen immer zwei jahre",
    "it": "il gli della delle dei di che è e un una per non sono con come più anche nel nella alla dal questo questa loro suo ma ha hanno essere lo la le si da in del dell sul sulla quando tutto molto dopo stato era due fra ogni così dove perché senza ancora anni parte prima sempre già può tra",
    "pt": "o os as da do das dos e é um uma que para com não por mais como mas foi ao ele ela seu sua ou ser quando muito nos já está eu também só pelo pela até isso em na no se são tem à pelos depois sem mesmo aos seus quem nas me esse eles você essa num nem suas meu às minha numa qual nós lhe dois anos então entre sobre ainda",
    "nl": "het een en van de is dat niet op te zijn met voor die aan er om ook als maar bij wordt door naar uit nog wel kan deze ik je hij ze we was heeft hebben had werd worden over meer dan zo dit geen tot of al onder veel tegen na zich zou moet twee jaar waar hoe wat alle andere tussen altijd hun",
}
TEXTS = {
    "en": "All human beings are born free and equal in dignity and rights. They are endowed with reason and conscience and should act towards one another in a spirit of brotherhood. Everyone is entitled to all the rights and freedoms set forth in this Declaration, without distinction of any kind, such as race, colour, sex, language, religion, political or other opinion, national or social origin, property, birth or other status. Everyone has the right to life, liberty and security of person. No one shall be held in slavery or servitude. No one shall be subjected to torture or to cruel, inhuman or degrading treatment or punishment. Everyone has the right to recognition everywhere as a person before the law.",
    "fr": "Tous les êtres humains naissent libres et égaux en dignité et en droits. Ils sont doués de raison et de conscience et doivent agir les uns envers les autres dans un esprit de fraternité. Chacun peut se prévaloir de tous les droits et de toutes les libertés proclamés dans la présente Déclaration, sans distinction aucune, notamment de race, de couleur, de sexe, de langue, de religion, d'opinion politique ou de toute autre opinion, d'origine nationale ou sociale, de fortune, de naissance ou de toute autre situation. Tout individu a droit à la vie, à la liberté et à la sûreté de sa personne. Nul ne sera tenu en esclavage ni en servitude. Nul ne sera soumis à la torture, ni à des peines ou traitements cruels, inhumains ou dégradants. Chacun a le droit à la reconnaissance en tous lieux de sa personnalité juridique.",
    "es": "Todos los seres humanos nacen libres e iguales en dignidad y derechos y, dotados como están de razón y conciencia, deben comportarse fraternalmente los unos con los otros. Toda persona tiene todos los derechos y libertades proclamados en esta Declaración, sin distinción alguna de raza, color, sexo, idioma, religión, opinión política o de cualquier otra índole, origen nacional o social, posición económica, nacimiento o cualquier otra condición. Todo individuo tiene derecho a la vida, a la libertad y a la seguridad de su persona. Nadie estará sometido a esclavitud ni a servidumbre. Nadie será sometido a torturas ni a penas o tratos crueles, inhumanos o degradantes. Todo ser humano tiene derecho, en todas partes, al reconocimiento de su personalidad jurídica.",
    "de": "Alle Menschen sind frei und gleich an Würde und Rechten geboren. Sie sind mit Vernunft und Gewissen begabt und sollen einander im Geiste der Brüderlichkeit begegnen. Jeder hat Anspruch auf alle in dieser Erklärung verkündeten Rechte und Freiheiten, ohne irgendeinen Unterschied, etwa nach Rasse, Hautfarbe, Geschlecht, Sprache, Religion, politischer oder sonstiger Anschauung, nationaler oder sozialer Herkunft, Vermögen, Geburt oder sonstigem Stand. Jeder hat das Recht auf Leben, Freiheit und Sicherheit der Person. Niemand darf in Sklaverei oder Leibeigenschaft gehalten werden. Niemand darf der Folter oder grausamer, unmenschlicher oder erniedrigender Behandlung oder Strafe unterworfen werden. Jeder hat das Recht, überall als rechtsfähig anerkannt zu werden.",
    "it": "Tutti gli esseri umani nascono liberi ed eguali in dignità e diritti. Essi sono dotati di ragione e di coscienza e devono agire gli uni verso gli altri in spirito di fratellanza. Ad ogni individuo spettano tutti i diritti e tutte le libertà enunciate nella presente Dichiarazione, senza distinzione alcuna, per ragioni di razza, di colore, di sesso, di lingua, di religione, di opinione politica o di altro genere, di origine nazionale o sociale, di ricchezza, di nascita o di altra condizione. Ogni individuo ha diritto alla vita, alla libertà ed alla sicurezza della propria persona. Nessun individuo potrà essere tenuto in stato di schiavitù o di servitù. Nessun individuo potrà essere sottoposto a tortura o a trattamento o a punizioni crudeli, inumani o degradanti.",
    "pt": "Todos os seres humanos nascem livres e iguais em dignidade e em direitos. Dotados de razão e de consciência, devem agir uns para com os outros em espírito de fraternidade. Todos os seres humanos podem invocar os direitos e as liberdades proclamados na presente Declaração, sem distinção alguma, nomeadamente de raça, de cor, de sexo, de língua, de religião, de opinião política ou outra, de origem nacional ou social, de fortuna, de nascimento ou de qualquer outra situação. Todo o indivíduo tem direito à vida, à liberdade e à segurança pessoal. Ninguém será mantido em escravatura ou em servidão. Ninguém será submetido a tortura nem a penas ou tratamentos cruéis, desumanos ou degradantes.",
    "nl": "Alle mensen worden vrij en gelijk in waardigheid en rechten geboren. Zij zijn begiftigd met verstand en geweten, en behoren zich jegens elkander in een geest van broederschap te gedragen. Een ieder heeft aanspraak op alle rechten en vrijheden, in deze Verklaring opgesomd, zonder enig onderscheid van welke aard ook, zoals ras, kleur, geslacht, taal, godsdienst, politieke of andere overtuiging, nationale of maatschappelijke afkomst, eigendom, geboorte of andere status. Een ieder heeft het recht op leven, vrijheid en onschendbaarheid van zijn persoon. Niemand zal in slavernij of horigheid gehouden worden. Niemand zal onderworpen worden aan folteringen, noch aan een wrede, onmenselijke of onterende behandeling of bestraffing.",
}
CODES = tuple(WORDS)
BITS, SMOOTH = 16, 0.3
#: Characters of a piece, pieces of a neighbourhood, a language's least share, and how far above an unknown trigram the mean must be.
PIECE, AROUND, LEAST, KNOWN = 16, 2, 0.1, 0.8
_OTHER = re.compile(r"[\W\d_]+")


def _trigrams(text: str) -> np.ndarray:
    """Buckets of the trigrams of the letters of a text, a blank between words."""
    letters = np.frombuffer(f" {_OTHER.sub(' ', text.lower()).strip()} ".encode("utf-32-le"), dtype=np.uint32).astype(np.uint64)
    if len(letters) < 3:
        return np.zeros(0, dtype=np.int64)
    mixed = (letters[:-2] * np.uint64(0x9E3779B1) + letters[1:-1]) * np.uint64(0x85EBCA77) + letters[2:]
    return ((mixed * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - BITS)).astype(np.int64)


@lru_cache(maxsize=1)
def _profiles() -> tuple[np.ndarray, float]:
    """Log-probabilities by bucket and language, and that of an unknown trigram."""
    counts = np.stack([np.bincount(_trigrams(TEXTS[k] + " " + WORDS[k]), minlength=1 << BITS) for k in CODES], axis=1).astype(float)
    # Profiles of unlike lengths are made alike, so that none is favoured for what it lacks.
    share = counts / counts.sum(axis=0) * counts.sum(axis=0).mean() + SMOOTH
    logs = np.log(share / share.sum(axis=0))
    return logs.astype(np.float32), float(logs.min())


def detected(text: str) -> dict[str, float]:
    """The languages of a text and their weights, which add up to one at most."""
    logs, unknown = _profiles()
    grams = _trigrams(text)
    if not len(grams):
        return {}
    starts = np.arange(0, len(grams), PIECE)
    sums = np.add.reduceat(logs[grams], starts, axis=0)
    sizes = np.diff(np.append(starts, len(grams)))
    total = np.concatenate([np.zeros((1, len(CODES))), np.cumsum(sums, axis=0, dtype=float)])
    length = np.append(0, np.cumsum(sizes))
    first, last = np.maximum(np.arange(len(starts)) - AROUND, 0), np.minimum(np.arange(len(starts)) + AROUND + 1, len(starts))
    mean = (total[last] - total[first]) / (length[last] - length[first])[:, None]
    best = mean.argmax(axis=1)
    known = mean[np.arange(len(best)), best] > unknown + KNOWN
    share = np.bincount(best[known], weights=sizes[known], minlength=len(CODES)) / sizes.sum()
    return {CODES[k]: float(x) for k, x in enumerate(share) if x >= LEAST}


@F.arrow_udf(T.MapType(T.StringType(), T.DoubleType()))
def _weights(texts: pa.Array) -> pa.Array:
    return pa.array([list(detected(t).items()) if (t := x.as_py()) else [] for x in texts], pa.map_(pa.string(), pa.float64()))


def weights(text: Column) -> Column:
    """map of language code to weight; empty when none is reliable."""
    return _weights(text)
