"""Fixed voters on insulting text: word lists per language, and patterns.

The lists are ordinary insults of each language in lower case, without words that are plain ones
in another of the languages. Patterns look at how a text speaks: whom it addresses, threats,
dismissals, shouting and spellings that hide a word.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

WORDS = {
    "en": "arsehole asshole bastard bitch bonehead bozo brainless buffoon bullshit clueless "
          "coward cretin creep crook deadbeat degenerate delusional despicable dimwit dipshit "
          "douchebag dullard dumb dumbass dunce fool foolish freak halfwit hag hypocrite "
          "idiot idiotic ignoramus imbecile incompetent inbred jackass jerk kook laughable liar "
          "loathsome lowlife lunatic maggot moron moronic motherfucker nitwit numbskull oaf "
          "pathetic pervert prick psycho repulsive retarded revolting scoundrel "
          "scum scumbag shithead sicko simpleton slimeball slut spineless stupid swine thug traitor "
          "troll twat twerp twit vermin vile wanker weirdo whore wimp witless wretch",
    "de": "abschaum arsch arschloch arschgeige bastard blödmann depp dreckskerl drecksau dumm "
          "dummkopf dummschwätzer dämlich erbärmlich feigling flachpfeife gesindel hackfresse heuchler "
          "hohlkopf hornochse hure hurensohn idiot idiotisch kotzbrocken kretin lügner "
          "miststück mistkerl nichtsnutz penner pissnelke rotznase saukerl "
          "schlampe schwachkopf schwachsinnig schweinehund spast trottel verlierer vollidiot "
          "vollpfosten volltrottel widerling wichser armleuchter",
    "nl": "achterlijk eikel etterbak hoer hufter idioot kakker klootzak kutwijf leugenaar lafaard "
          "lul lulletje mafkees malloot minkukel mongool oelewapper randdebiel rotzak schoft "
          "slappeling slet smeerlap sukkel trut tuig uilskuiken viezerik waardeloos zakkenwasser",
    "fr": "abruti andouille bouffon branleur conasse connard connasse couillon crapule crétin débile "
          "dégueulasse enculé enfoiré fumier idiot idiote imbécile lavette "
          "menteur minable pétasse pouffiasse raclure racaille salaud "
          "salopard salope stupide tocard trouduc vaurien vermine",
    "es": "asqueroso baboso bastardo basura bobo cabrón canalla capullo cretino desgraciado estúpido "
          "estúpida escoria gilipollas hijueputa idiota imbécil inútil lameculos malnacido "
          "mamón mentiroso mugroso necio parásito patético payaso pendejo puta puto "
          "subnormal tarado tonto zopenco zorra",
    "it": "bastardo buffone bugiardo cafone cialtrone coglione cornuto cretino deficiente demente "
          "disgustoso fesso feccia idiota imbecille infame mascalzone minorato mongoloide pagliaccio "
          "patetico pezzente puttana rincoglionito scemo schifoso sfigato stolto stronza stronzo "
          "stupido verme vigliacco",
    "pt": "arrombado asqueroso babaca besta boçal cretino cuzão desgraçado escroto estúpido "
          "fedelho fracassado idiota imbecil lixo mentiroso nojento otário palerma palhaço paspalho "
          "patético parvalhão trouxa vadia vagabundo verme",
    "ru": "болван выродок гад дебил долбоёб дурак дура идиот идиотка козёл кретин лжец мерзавец мразь "
          "мудак негодяй ничтожество отброс отморозок подлец подонок придурок свинья сволочь скотина "
          "сука тварь трус тупица тупой ублюдок урод шлюха",
    "pl": "cham ciota debil dupek dureń dziwka frajer gnida gnojek głupek głupia głupi hołota idiota "
          "idiotka kretyn kurwa kłamca kutas łajdak matoł menda nieudacznik oszołom palant przygłup "
          "skurwiel skurwysyn szmata szuja śmieć świnia tchórz żałosny",
}
#: Endings that are added to every word of the lists.
ENDINGS = ("", "s", "es", "e", "en", "er", "n", "a", "as", "os")
#: Languages whose lists make one voter, and the pattern voters.
LISTS = (("en",), ("de", "nl"), ("fr", "es", "it", "pt"), ("ru", "pl"))
PATTERNS = ("address", "threat", "dismissal", "shouting", "masked")

#: Words that address a reader.
YOU = frozenset(w.encode() for w in (
    "you your yours youre ya u ur yall du dich dir dein deine deinen ihr euch jij je jou jouw jullie "
    "tu te ti toi ton ta tes vous votre vos tú usted ustedes sos eres vos sei voi siete tuo tua "
    "você vocês teu seu sua ты тебя тебе твой твоя вы вас ваш ty ciebie ci twój twoja wy was").split())

_I = r"(?:i['’]?ll|i will|i am going to|i['’]?m going to|i['’]?m gonna|i wanna|we['’]?ll|we will|someone should|somebody should)"
_THREATS = (
    _I + r" (?:\pL+ )?(?:kill|hurt|beat|stab|shoot|strangle|destroy|find|smash|crush|break|punch|hunt) (?:you|u|your)",
    r"(?:kill|hang|shoot|drown) (?:yourself|urself|yourselves)", r"hope (?:you|u) (?:all )?(?:die|rot|suffer|burn)",
    r"(?:you|u) (?:will|should|deserve to|need to|must|gonna) (?:die|rot|suffer|pay for|regret|burn|be shot|be hanged)",
    r"watch your back", r"i know where you live", r"you['’]?re dead", r"go die", r"drop dead",
    r"ich (?:bring|bringe|schlag|schlage|mach|mache) (?:dich|euch) (?:um|tot|fertig|kaputt)", r"verreck(?:e|t)?",
    r"ik (?:maak|sla|schiet|trap) (?:je|jou|jullie) (?:dood|kapot|verrot|af)", r"val dood",
    r"je vais (?:te|vous) (?:tuer|buter|crever|démolir|frapper|retrouver|casser)", r"cr[èe]ve", r"va crever",
    r"(?:te|os|los) voy a (?:matar|reventar|romper|partir|pegar|encontrar)", r"mu[ée]rete", r"ojal[áa] te mueras",
    r"(?:ti|vi) (?:ammazzo|uccido|spacco|distruggo)", r"devi morire", r"crepa",
    r"(?:vou|vamos) (?:te|vos) (?:matar|quebrar|arrebentar|bater|destruir)", r"morre logo",
    r"(?:я )?(?:тебя|вас) (?:убью|прикончу|найду|порву)", r"сдохни", r"zabij[ęe] ci[ęe]", r"zdychaj",
)
_DISMISSALS = (
    r"shut (?:the (?:hell|fuck) )?up", r"shut your (?:mouth|face|trap)", r"go to hell", r"get lost", r"fuck (?:off|you|u)",
    r"screw you", r"piss off", r"nobody (?:likes|wants|asked|cares about) (?:you|u)", r"no one (?:likes|wants) (?:you|u)",
    r"(?:you|u) make me sick", r"you people", r"your kind", r"people like you", r"go back to (?:your|where)", r"you disgust",
    r"halt(?:et)? (?:die|dein|deine|den) (?:klappe|maul|mund|fresse|schnauze)", r"verpiss dich", r"leck mich", r"fick dich",
    r"hau ab", r"hou je (?:mond|bek|kop|smoel)", r"rot op", r"krijg de", r"ferme (?:ta|la) (?:gueule|bouche)", r"ta gueule",
    r"va te faire", r"casse[- ]toi", r"d[ée]gage", r"nique ta", r"c[áa]llate", r"vete a la", r"que te (?:jodan|den)", r"chinga tu",
    r"l[áa]rgate", r"sta['’]? zitto", r"chiudi (?:la|quella) bocca", r"vaffanculo", r"vai a(?:l|ll['’])? ?(?:diavolo|inferno)",
    r"cala a? ?(?:tua )?boca", r"vai se foder", r"vai tomar no", r"заткнись", r"пош[ёе]л (?:ты|на|вон)", r"zamknij si[ęe]",
    r"spierdalaj", r"odwal si[ęe]",
)


def _phrases(parts: tuple[str, ...]) -> str:
    return r"(?:^|[^\pL])(?:" + "|".join(parts).replace(" ", r"\s+") + r")(?:[^\pL]|$)"


_THREAT, _DISMISSAL = _phrases(_THREATS), _phrases(_DISMISSALS)
_SHOUTING = r"[!?]{3,}|\p{Lu}{3,}(?:[^\pL]+\p{Lu}{3,}){3}"
_HIDDEN = (r"\pL[0-9@$*#!|+]+\pL|(?:^|\s)[@$0-9]\pL|(?i:a{3}|e{3}|i{3}|o{3}|u{3})"
           r"|(?:^|[^\pL\d])\pL(?:[ ._*-]\pL){3,}(?:[^\pL\d]|$)")
_FOLD = str.maketrans("01345789@$!|+", "oieastbgasiit")
_SIGN, _SPACED = re.compile(r"[0-9@$*#!|+]"), re.compile(r"(?<!\w)[^\W\d_](?:[ ._*-][^\W\d_]){3,}(?!\w)")
_PARTS, _RUN = re.compile(r"[\s/,;:\"().?…-]+"), re.compile(r"([^\W\d_])\1{2,}")

#: Every form of every listed word, with its languages.
FORMS: dict[str, set[str]] = {}
for _lang, _list in WORDS.items():
    for _word in _list.split():
        for _end in ENDINGS:
            FORMS.setdefault(_word + _end, set()).add(_lang)
_ENCODED = frozenset(w.encode() for w in FORMS)
_BY_SIZE: dict[int, list[str]] = {}
for _form in FORMS:
    _BY_SIZE.setdefault(len(_form), []).append(_form)
_LONGEST = max(_BY_SIZE)


def addressed(words: list[bytes]) -> bool:
    """An insult with at most three words between it and a word that addresses the reader."""
    you = insult = -9
    for k, word in enumerate(words):
        you = k if word in YOU else you
        insult = k if word in _ENCODED else insult
        if abs(you - insult) <= 4 and max(you, insult) == k and min(you, insult) >= 0:
            return True
    return False


def masked(text: str) -> bool:
    """A listed word with signs for letters, drawn-out vowels, or its letters parted."""
    text = text.lower()
    for part in _PARTS.split(text):
        part = part.strip("*#!|+")
        if not 4 <= len(part) <= 4 * _LONGEST:
            continue
        plain = _RUN.sub(r"\1", part)
        if plain != part and part not in FORMS and plain in FORMS:
            return True
        if not _SIGN.search(plain) or plain.isdigit():
            continue
        plain = plain.translate(_FOLD)
        if plain in FORMS:
            return True
        if ("*" in plain or "#" in plain) and sum(c.isalpha() for c in plain) >= 2 and any(
                all(a == b or a in "*#" for a, b in zip(plain, w)) for w in _BY_SIZE.get(len(plain), ())):
            return True
    for run in _SPACED.finditer(text):
        letters = re.sub(r"[ ._*-]", "", run[0])
        if letters in FORMS or any(len(w) > 4 and w in letters for w in FORMS):
            return True
    return False


def fired(texts: list[str], letters: bytes, listed: np.ndarray) -> np.ndarray:
    """Texts by PATTERNS: which fire. ``listed`` texts hold a listed word; ``letters`` is the
    table that blanks all but letters."""
    out = np.zeros((len(texts), len(PATTERNS)), bool)
    column = pa.array([t.encode("utf-8", "replace").decode() for t in texts], pa.large_string())
    for k, pattern in ((1, _THREAT), (2, _DISMISSAL), (3, _SHOUTING), (4, _HIDDEN)):
        out[:, k] = pc.match_substring_regex(column, pattern, ignore_case=k < 3).to_numpy(
            zero_copy_only=False)
    for k in np.flatnonzero(listed):
        out[k, 0] = addressed(texts[k].lower().encode("utf-8", "replace").translate(letters).split())
    for k in np.flatnonzero(out[:, 4]):
        out[k, 4] = masked(texts[k])
    return out
