"""Fixed sentences that give the abuse model a start, built from short lists of words.

They hold offensive words because the model has to know them. Harmless sentences that
treat such matters as a subject, or use such words in another sense, stand beside them.
"""

from __future__ import annotations

from itertools import cycle

# Strong words that are looked for behind stars and spaced letters.
STRONG_WORDS = """idiot idiots moron morons imbecile imbeciles bastard bastards asshole assholes scumbag scumbags dimwit dimwits
dumbass jackass bitch bitches whore whores slut sluts cunt dick dickhead prick pussy shit shitty bullshit fuck fucking fucker
fucked stupid loser losers coward liar liars parasite parasites vermin trash filth clown clowns retard worthless useless
pathetic disgusting filthy miserable braindead gutless porn porno nude nudes naked horny sex sexy tits boobs cock blowjob
masturbate masturbating xxx kill rats pigs subhuman
arschloch wichser hurensohn schlampe schwachkopf vollidiot trottel scheisse dummkopf missgeburt fotze drecksau ungeziefer nackt
geil nacktbilder verpiss abschaum
connard connasse salope pute encule merde cretin abruti batard ordure vermine nique nue nues
cabron gilipollas imbecil puta mierda pendejo cretino estupido basura escoria desnuda desnudas cachondo maricon hijoputa
""".split()

_ADJECTIVES = "stupid filthy worthless pathetic useless disgusting miserable fucking dirty damn".split()
_INSULTS = "idiot moron asshole bastard scumbag loser imbecile bitch parasite clown liar dickhead coward retard jerk fool".split()
_INSULT_FRAMES = [
    "you are a {a} {i}", "you {a} {i}", "what a {a} {i} you are", "shut up {i}", "shut your mouth you {a} {i}", "that man is a {a} {i}",
    "listen you {a} {i}", "only a {i} like you would write this", "the boss is a {a} {i}", "all of them are {a} {i}s", "fuck you {i}",
    "go to hell you {i}", "get lost you {a} {i}", "hey {i} nobody likes you", "you and your friends are {a} {i}s", "this {i} should be fired {i}",
    "I hope you rot in hell {i}", "piece of shit", "eat shit you {i}", "fuck off {i}", "you are nothing but a {i}",
]
_THREATS = [
    "I will kill you", "I am going to hurt you and your family", "I know where you live and I will come for you", "we will burn your house down",
    "you will bleed for this", "you will pay for this with your life", "somebody should shoot you", "people like you should be shot",
    "you deserve to die", "I hope you die slowly", "I hope you get cancer", "watch your back tonight", "they will find your body in the river",
    "you should be hanged", "go and kill yourself", "the world would be better without you", "nobody would cry if you were dead",
    "I will break your legs", "someone should beat you up", "you should have been drowned at birth", "your mother should have aborted you",
    "I will smash your face", "you won't live to see next week", "we know where your children go to school",
]
_VEILED = [
    "you have the brain of a stone", "your head is emptier than a barrel", "even a monkey is smarter than you", "you are too dumb to breathe",
    "nobody wants you here", "you make me sick", "you are a waste of space and air", "your face makes children cry", "your IQ is below zero",
    "you could not find your own backside with a map", "crawl back under your rock", "you are as thick as a plank",
]
_GROUPS = """immigrants foreigners refugees women men blacks whites muslims jews christians gays lesbians gypsies asians mexicans arabs
northerners southerners farmers villagers disabled-people old-people poor-people believers heathens islanders highlanders""".replace("-", " ").split()
_GROUPS = [g for g in _GROUPS if g != "people"]
_HATE = [
    "{g} are vermin", "all {g} are thieves and liars", "{g} are not human", "{g} are subhuman trash", "{g} should be driven out of the country",
    "send all {g} back where they came from", "{g} breed like rats", "{g} are a disease", "we should get rid of the {g}", "the {g} deserve to be beaten",
    "never trust {g} they are all criminals", "{g} are too stupid to work here", "I hate {g} and everything they believe", "do not hire {g} they are filth",
    "{g} belong in a cage", "{g} should not be allowed to vote", "the only good {g} are dead {g}", "where {g} live nobody is safe",
    "without {g} the world would be clean", "{g} ruin everything they touch", "those {g} are animals",
]
_SEXUAL = [
    "send me your nude pics", "I want to see you naked", "I am so horny for you", "hot girls live sex show", "free porn videos uncensored",
    "watch hardcore xxx videos now", "take off your clothes for me", "I want to touch your tits", "I want you in my bed tonight",
    "I imagine you naked on your knees", "let me lick you all over", "best blowjob ever", "horny singles in your area want sex",
    "nude cams girls masturbating live", "show me your boobs", "I dream of undressing you and feeling your body", "I will make you moan",
    "leaked nude photos of the secretary", "escort girl does everything ask for prices", "come to the hotel room and I will fuck you",
    "sleep with me and you get the promotion", "what do you wear under that skirt", "let me put my hand under your dress",
]
_GERMAN = [
    "du bist ein dummer idiot", "halt die fresse du arschloch", "halt dein maul du trottel", "verpiss dich du wichser", "du dreckiger hurensohn",
    "wer das schreibt ist ein schwachkopf", "der chef ist ein vollidiot", "ich bringe dich um", "ich weiss wo du wohnst", "du wirst bluten",
    "man sollte dich erschiessen", "leute wie du gehören vergast", "leute wie du sollten nicht leben", "du hast das hirn einer mücke",
    "ausländer sind ungeziefer", "die fremden gehören rausgeworfen", "frauen sind zu dumm dafür", "diese leute sind dreckige diebe",
    "das sind untermenschen", "ohne ausländer wäre die welt sauberer", "schick mir nacktbilder", "ich bin so geil auf dich",
    "zieh dich für mich aus", "geile pornos unzensiert", "nackte frauen live", "ich stelle mir dich nackt vor", "ertränken sollte man dich",
    "niemand würde dich vermissen", "du bist der letzte abschaum", "fahr zur hölle du drecksau",
]
_FRENCH = [
    "tu es un sale con", "ferme ta gueule connard", "espèce d'abruti", "va te faire foutre", "pauvre crétin", "fils de pute", "sale pute",
    "celui qui a écrit ça est un imbécile", "je vais te tuer", "je sais où tu habites", "tu vas saigner", "il faudrait te pendre",
    "des gens comme toi ne méritent pas de vivre", "tu as le cerveau d'une huître", "les étrangers sont de la vermine",
    "ces gens sont des voleurs", "ce sont des sous-hommes", "qu'on les chasse tous", "les femmes sont trop bêtes", "race inférieure",
    "le monde serait plus propre sans eux", "envoie-moi tes photos nue", "je suis excité par toi", "vidéos porno sans censure",
    "je t'imagine nue à genoux", "déshabille-toi pour moi", "filles nues en direct", "personne ne te regretterait", "on devrait te jeter à l'eau",
    "tu me dégoûtes sale ordure",
]
_SPANISH = [
    "eres un estúpido imbécil", "cierra la boca idiota", "vete a la mierda", "hijo de puta", "eres un cabrón", "pobre gilipollas",
    "quien escribió esto es un cretino", "te voy a matar", "sé dónde vives", "vas a sangrar", "habría que ahorcarte",
    "la gente como tú no debería vivir", "tienes el cerebro de un mosquito", "los extranjeros son alimañas", "hay que echarlos a todos",
    "son infrahumanos", "esos son basura y ladrones", "las mujeres son demasiado tontas", "sin ellos el mundo estaría más limpio",
    "mándame fotos desnuda", "estoy cachondo", "sexo sin censura", "chicas desnudas en vivo", "te imagino desnuda de rodillas",
    "quítate la ropa para mí", "nadie te echaría de menos", "habría que tirarte al mar", "das asco escoria", "vídeos porno gratis",
    "aquí no pintan nada",
]
_JAPANESE = [
    "お前は馬鹿だ", "黙れクズ", "死ね", "殺してやる", "このゴミ野郎", "役立たずのクズめ", "消えろブス", "お前の家を知っているぞ", "血を見ることになる",
    "お前なんか生きる価値がない", "お前の脳みそは空っぽだ", "あの連中は害虫だ", "外国人は出て行け", "あいつらは泥棒ばかりだ", "あいつらは人間以下だ",
    "女は馬鹿だから会社を任せるな", "あいつらがいなければ世の中は良くなる", "裸の写真を送れ", "無修正ポルノ動画", "お前の裸を想像している",
    "服を脱げ", "セックスしたい", "今夜ベッドに来い", "エロ動画を見ろ", "川に沈めてやる", "誰もお前を惜しまない", "くたばれ間抜け", "気持ち悪い死んでくれ",
]
_HARMLESS = [
    "the company revised its policy against sexual harassment", "an employee reported insults at work to the hotline", "we train staff to recognise hate speech",
    "the court fined a man for threats against an officer", "the report describes violence against women", "victims of sexual abuse were offered support",
    "the documentary deals with the porn industry and its victims", "the platform removes pornographic content and hate speech",
    "discrimination against foreigners is not tolerated", "the study counts insults such as idiot in comments", "the word was used as an insult in the complaint",
    "the fund supports refugees and immigrants", "women hold forty percent of the management positions", "we hired old people and young people alike",
    "they killed it this quarter", "the short sellers got killed", "this stock is a dog", "what a sick result", "shorts are squeezed to death",
    "the margin was a slap in the face", "that chart looks ugly", "the spread is awful", "I was stupid to sell at the low", "I feel like an idiot for buying at the top",
    "hot sector and cool price", "the dirty price of the bond", "a killer application", "we burn cash", "the deal died", "cut the fat and trim the losses",
    "I disagree with your view", "your analysis is wrong and superficial", "management should do better", "the presentation was boring", "this is a bad decision",
    "your numbers do not add up", "the board failed its shareholders", "the answer was weak and evasive", "I do not trust this guidance", "poor work by the auditors",
    "the plant uses pesticides against vermin and rats", "parasites in livestock reduced the yield", "the drug treats parasites", "the sex of the animals is recorded",
    "breast cancer drug approved", "naked short selling is forbidden", "the adult education business grew", "trash collection and waste removal",
    "please send me the invoice", "thank you for the summary", "see you at the meeting tonight", "what time is the call", "I added shares after the report",
    "nobody knows where the price will go", "you are right about the margin", "you should read the annual report", "people like you make this forum useful",
    "the team deserves credit", "your house view on rates", "I know where the growth comes from", "everyone in this company works hard",
    "die richtlinie gegen sexuelle belästigung wurde überarbeitet", "der kurs ist brutal gefallen", "ich halte die entscheidung für falsch", "die analyse ist schwach",
    "mitarbeiter meldeten beleidigungen an die hotline", "frauen sind im vorstand vertreten", "der umsatz stieg im ersten halbjahr", "das ergebnis lag über dem vorjahr",
    "la politique contre le harcèlement a été révisée", "la décision est mauvaise", "l'analyse est faible", "des salariés ont signalé des insultes",
    "les femmes occupent la moitié des postes", "le chiffre d'affaires a progressé", "la marge a reculé au premier semestre", "je ne suis pas d'accord avec vous",
    "la política contra el acoso sexual fue revisada", "la decisión es mala", "el análisis es flojo", "los empleados denunciaron insultos",
    "las mujeres ocupan la mitad de los puestos", "los ingresos crecieron", "el margen cayó en el semestre", "no estoy de acuerdo con usted",
    "ハラスメント防止規程を改定した", "性的嫌がらせの通報があった", "差別的な発言は許されない", "売上高は前年を上回った", "取締役会は計画を承認した", "女性管理職の比率が上昇した",
    "この判断には賛成できない", "説明が不十分だ", "外国人の採用を増やした", "株価が死ぬほど下がった",
]


def sentences() -> tuple[list[str], list[int]]:
    """(sentences, labels): 1 for offensive ones."""
    bad: list[str] = []
    adjectives, insults, groups = cycle(_ADJECTIVES), cycle(_INSULTS), cycle(_GROUPS)
    for frame in _INSULT_FRAMES:
        # 16 insults and 10 adjectives: every frame meets a changing choice of both.
        bad += [frame.format(a=next(adjectives), i=next(insults)) for _ in range(9 if "{" in frame else 1)]
    for frame in _HATE:
        bad += [frame.format(g=next(groups)) for _ in range(9)]
    bad += 3 * (_THREATS + _VEILED + _SEXUAL) + 3 * (_GERMAN + _FRENCH + _SPANISH + _JAPANESE)
    neutral = [f"the {g} in the region" for g in _GROUPS] + [f"{g} and their families" for g in _GROUPS] + [f"a programme for {g}" for g in _GROUPS]
    good = 4 * _HARMLESS + neutral
    return bad + good, [1] * len(bad) + [0] * len(good)
